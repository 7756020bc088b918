"""Shared folder for intermediate tables, and size checks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most values of one axis that are carried inside the plan as an array literal.
AXIS_LIMIT = 4096


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees, as named in ``spark.checkpoint.dir``.

    Where it is not set, a single machine uses its warehouse folder; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables, on whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(
    df: DataFrame, name: str, folder: str | None = None, partition_by: str | None = None
) -> DataFrame:
    """Write ``df`` once and read it back: short lineage, known size, pruned columns.

    A lost executor re-reads the table instead of parsing the sources again.
    """
    spark = df.sparkSession
    folder = folder or shared_dir(spark)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_parts(
    parts: Iterable[DataFrame], name: str, folder: str | None = None, tasks: int | None = None
) -> DataFrame | None:
    """Write frames of one schema as one table, each before the next is made, and read it back.

    None if there is none. ``tasks`` bounds the files that each adds to the table.
    """
    table = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        table = table or f"{(folder or shared_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        (df.coalesce(tasks) if tasks else df).write.mode("append").parquet(table)
        # It may hold an index of files, gone before the next is made: py4j's proxies refer to themselves, and
        # the JVM keeps what they stand for until Python collects cycles.
        del df
        gc.collect()
    return None if table is None else spark.read.schema(schema).parquet(table).select(*schema.names)


def one_or_staged(
    parts: Iterator[DataFrame], name: str, folder: str | None = None, tasks: int | None = None
) -> DataFrame | None:
    """The only frame as it is, or several staged as one table; None if there is none."""
    first = [*islice(parts, 2)]
    if len(first) < 2:
        return first[0] if first else None

    def every() -> Iterator[DataFrame]:
        while first:
            yield first.pop(0)
        yield from parts

    return stage_parts(every(), name, folder, tasks)


@contextmanager
def held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while a block runs; what they were comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` itself if it only filters a stored table, else staged: what is used several times is computed once."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    return df if plan.nodeName().startswith(("LogicalRelation", "Relation")) else stage(df, name, folder)


def computed_once(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Add columns through a generator, which no later filter or projection repeats.

    A plain projection is merged into the filters above it, and its regexes and
    casts then run once per use.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def distinct_values(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a column that become names of columns."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def small_values(df: DataFrame, column: str, limit: int = AXIS_LIMIT) -> list[str] | None:
    """Sorted distinct values of a column, or None when there are more than ``limit``."""
    rows = (
        df.select(column).where(F.col(column).isNotNull()).distinct()
        .orderBy(column).take(limit + 1)
    )
    return None if len(rows) > limit else [r[0] for r in rows]
