"""Result folders of which readers see one whole version, also while the next is written or fails.

Every run writes below ``<folder>/_versions/<version>``. One small file, ``<folder>/_published``, names the
versions that were finished, newest first; it is replaced by one rename once all tables of a version
are there. A job that ends before leaves the published version as it was, and a folder that no reader is sent to.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from scalargrid.runtime import remove_dir

_MANIFEST = "_published"


def new_version(folder: str) -> str:
    """Path for the tables of a version to come; names follow each other in time."""
    return f"{folder.rstrip('/')}/_versions/{time.time_ns():020d}-{uuid.uuid4().hex}"


def _manifest(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{_MANIFEST}")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Paths of published versions that were kept, newest first."""
    path, files = _manifest(spark, folder)
    if not files.exists(path):
        return []
    stream = files.open(path)
    try:
        names = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()
    return [f"{folder.rstrip('/')}/_versions/{name}" for name in names]


def published(spark: SparkSession, folder: str) -> str:
    """Path of the version that readers should use."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return found[0]


def publish(spark: SparkSession, version: str, keep: int = 2) -> None:
    """Make ``version``, whose tables are all written, the one that readers see.

    The ``keep`` newest versions stay, so that readers of the former one can finish; older ones are removed. Of two
    jobs that publish at once the later wins, and the folder of the other may stay.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is published")
    folder, name = version.rsplit("/_versions/", 1)
    before = versions(spark, folder)
    stay = [version, *(v for v in before if v != version)][:keep]
    path, files = _manifest(spark, folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fresh = jvm.org.apache.hadoop.fs.Path(f"{folder}/{_MANIFEST}-{name}")
    stream = files.create(fresh, True)
    try:
        stream.write("\n".join(v.rsplit("/", 1)[1] for v in stay).encode())
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    full = files.makeQualified(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), conf).rename(files.makeQualified(fresh), full, options)
    for old in before:
        if old not in stay:
            remove_dir(spark, old)
