"""File trees as DataFrames: listing and whole documents."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.runtime import held, one_or_staged, stage_parts
from scalargrid.sources.patterns import (
    DATASET_DESCRIPTION,
    GROUP_TABLE,
    RECON_FOLDER_PREFIX,
)

# Column of a group table that orders its rows.
ROW_ORDER = "_row_order"

# Files that one index in the driver's heap should hold, some 100 MB with the plan of its scan, and the
# folders of the first index, while it is unknown how many files are in one.
INDEX_FILES = 50_000
FIRST_FOLDERS = 256


def _labels(prefix: str, labels: Sequence[str] | None) -> str:
    """Glob for one folder level: ``sub-*`` or ``sub-{01,02}``."""
    return f"{prefix}{{{','.join(sorted(labels))}}}" if labels else f"{prefix}*"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    file_system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = file_system.globStatus(location)
    return found is not None and len(found) > 0


def preproc_globs(root: str, subjects: Sequence[str] | None = None) -> list[str]:
    """Load globs of the preprocessing tree; include-lists skip whole folders."""
    root = root.rstrip("/")
    return [f"{root}/{_labels('sub-', subjects)}", f"{root}/{DATASET_DESCRIPTION}"]


def recon_globs(
    spark: SparkSession,
    root: str,
    subjects: Sequence[str] | None = None,
    recon_suffixes: Sequence[str] | None = None,
) -> list[str]:
    """Load globs of the reconstruction tree, below ``derivatives`` if that exists."""
    root = root.rstrip("/")
    if path_exists(spark, f"{root}/derivatives"):
        root = f"{root}/derivatives"
    recon = f"{root}/{_labels(RECON_FOLDER_PREFIX, recon_suffixes)}"
    return [f"{recon}/{_labels('sub-', subjects)}", f"{recon}/{DATASET_DESCRIPTION}"]


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _file_path() -> Column:
    """Decoded path of the file a row comes from."""
    return _decoded(F.col("_metadata.file_path"))


def _indexed_paths(frame: DataFrame) -> DataFrame:
    """``path`` of every file in the index of a scan, also of those without a byte, which scans leave out.

    The index was listed by Spark, by a job where there are many folders; its paths, of a bounded number
    of files, go from there to a table inside the JVM.
    """
    spark = frame.sparkSession
    session = spark._jsparkSession
    paths = spark.sparkContext._jvm.java.util.Collections.singletonList(frame._jdf.inputFiles())
    listed = DataFrame(session.createDataset(paths, session.implicits().newStringArrayEncoder()).toDF(), spark)
    # Without an authority the index writes "file:///x", rows write "file:/x".
    same = F.regexp_replace("path", r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    return listed.select(F.explode("value").alias("path")).select(_decoded(same).alias("path"))


def _named(spark: SparkSession, globs: Sequence[str]) -> list[str]:
    """What the globs name, folders mostly, each once and not inside of another, as globs that name only that."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.spark.deploy.SparkHadoopUtil.get()
    named = []
    for glob in globs:
        # In one piece: a call from Python for each would take longer than listing what is in it.
        found = hadoop.globPath(jvm.org.apache.hadoop.fs.Path(glob)).mkString("\0")
        named += found.split("\0") if found else []
    each = dict.fromkeys(named)
    alone = [path for path in each if not any(_listed_with(path, top) for top in accumulate(path.split("/")[:-1], "{}/{}".format) if top in each)]
    return [re.sub(r"([\\{}\[\]?*])", r"\\\1", path) for path in alone]


def _listed_with(path: str, top: str) -> bool:
    """Whether Spark lists ``path`` below the folder ``top``: hidden folders it leaves out."""
    return not any(part.startswith(("_", ".")) for part in path[len(top) + 1:].split("/"))


def _load(spark: SparkSession, fmt: str, folders: Sequence[str], **options: str) -> DataFrame | None:
    """One frame over all folders, so each call lists them once; those that went meanwhile are left out.

    Many folders are listed by a Spark job, not by the driver
    (``spark.sql.sources.parallelPartitionDiscovery.threshold``), in some tasks for each core: one for each
    folder would cost more than its listing. What is listed is not kept beyond the frame.
    """
    tasks = _tasks(spark)
    settings = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks),
        "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    }
    with held(spark, settings):
        reader = spark.read.format(fmt).options(recursiveFileLookup="true", **options)
        try:
            return reader.load(list(folders))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            left = [folder for folder in folders if path_exists(spark, folder)]
            return reader.load(left) if left else None


def _tasks(spark: SparkSession) -> int:
    """Tasks that one part of a tree is dealt into at most."""
    return max(32, 4 * spark.sparkContext.defaultParallelism)


def _frames(
    spark: SparkSession, fmt: str, globs: Sequence[str], **options: str
) -> Iterator[DataFrame]:
    """Frames over all that the globs name, one after another, each with an index of its own.

    Spark keeps the index of a scan, and plans its tasks, in the driver's heap. Each frame takes so many
    folders as should hold ``INDEX_FILES`` files by what the one before held, so that the driver's share
    does not grow with the tree; one folder is never cut.
    """
    folders = _named(spark, globs)
    at, take = 0, FIRST_FOLDERS
    while at < len(folders):
        frame = _load(spark, fmt, folders[at:at + take], **options)
        at += take
        if frame is None:
            continue
        if at < len(folders):
            per_folder = max(1, len(frame._jdf.inputFiles())) / take
            take = max(1, min(4 * take, int(INDEX_FILES / per_folder)))
        yield frame
        frame = None  # before the index of the next


def list_files(
    spark: SparkSession, globs: Sequence[str], name_regex: str | None = None, folder: str | None = None
) -> DataFrame:
    """Inventory ``(path, file_size)``, files without a byte included; file contents are not read.

    A tree of more folders than one index takes is listed in parts, staged in ``folder``.
    """
    parts = map(lambda frame: _listed(frame, name_regex), _frames(spark, "binaryFile", globs))
    found = one_or_staged(parts, "listed", folder, _tasks(spark))
    return spark.createDataFrame([], "path string, file_size long") if found is None else found


def _listed(frame: DataFrame, name_regex: str | None) -> DataFrame:
    sized = frame.select(_file_path().alias("path"), F.col("_metadata.file_size").alias("file_size"))
    if name_regex:
        # On the file's metadata, so that other files are dropped while the scan is planned.
        named = frame.where(F.col("_metadata.file_name").rlike(name_regex))
        sized = named.select(_file_path().alias("path"), F.col("_metadata.file_size").alias("file_size"))
    sized = sized.coalesce(_tasks(frame.sparkSession))
    every = _indexed_paths(frame)
    if name_regex:
        every = every.where(F.substring_index("path", "/", -1).rlike(name_regex))
    empty = every.join(sized.select("path"), "path", "left_anti").withColumn("file_size", F.lit(0).cast("long"))
    return sized.unionByName(empty)


def read_documents(
    spark: SparkSession, globs: Sequence[str], name_regex: str | None = None,
    without: DataFrame | None = None, name: str | None = None, folder: str | None = None,
) -> DataFrame:
    """``(path, content)``, one row per file of any size that can be read, but for paths in ``without``.

    A quoted cell may hold line breaks, so only a whole file can be cut into records. Files without
    a byte, broken ones and those that go while the job runs have no row; ``unread`` tells them.
    A tree of more folders than one index takes is read in parts, staged in ``folder``; with ``name``
    any tree is staged, under that name. Filters on file names drop files while a scan is planned,
    before any is opened.
    """
    def documents(frame: DataFrame) -> DataFrame:
        named = frame.where(F.col("_metadata.file_name").rlike(name_regex)) if name_regex else frame
        read = named.select(_file_path().alias("path"), F.col("value").alias("content"))
        return read if without is None else read.join(without, "path", "left_anti")

    frames = _frames(
        spark, "text", globs, wholetext="true", ignoreCorruptFiles="true", ignoreMissingFiles="true"
    )
    parts, tasks = map(documents, frames), _tasks(spark)
    found = stage_parts(parts, name, folder, tasks) if name else one_or_staged(parts, "documents", folder, tasks)
    return spark.createDataFrame([], "path string, content string") if found is None else found


def unread(documents: DataFrame, listed: DataFrame) -> DataFrame:
    """``(path, content)`` of each file of the inventory ``listed`` that has no row in ``documents``.

    Its content is empty where the file is, else NULL: it could not be read. The parsers turn both into warnings.
    """
    missing = listed.join(documents.select("path"), "path", "left_anti")
    return missing.select("path", F.when(F.col("file_size") == 0, F.lit("")).alias("content"))


def plain_root(spark: SparkSession, root: str) -> str:
    """Absolute path of a folder as it stands in the paths of its files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toUri().getPath()


def read_group_table(spark: SparkSession, folder: str) -> DataFrame | None:
    """The group-level metrics table with all cells as text, or None if absent.

    ``_row_order`` orders the rows as in the file. Ids stay text, so that leading
    zeros survive.
    """
    path = f"{folder.rstrip('/')}/{GROUP_TABLE}"
    if not path_exists(spark, path):
        return None
    table = (
        spark.read.option("sep", "\t").option("header", True).csv(path)
        .select(
            "*",
            F.col("_metadata.file_block_start").alias("_split_start"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    names: dict[str, str] = {}
    for c in table.columns:
        if c not in ("_split_start", "_place"):
            # Of names that differ in case or blanks only, the first column counts.
            names.setdefault(c.strip().lower(), c)
    renamed = [F.col(f"`{c}`").alias(name) for name, c in names.items() if name != ROW_ORDER]
    return table.select(F.struct("_split_start", "_place").alias(ROW_ORDER), *renamed)
