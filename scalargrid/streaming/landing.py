"""Land new source files as one row table, each file once.

Trees of many small files are slow to list and open again on every run. The file
source of Structured Streaming remembers the files it has seen, so each trigger
parses only new ones and appends their rows to a table that later jobs read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scalargrid.sources.tables import table_rows


def stream_documents(
    spark: SparkSession, glob: str, name_regex: str, max_files_per_trigger: int = 100_000
) -> DataFrame:
    """Unbounded ``(path, content)`` of the files that match."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(glob)
        .where(F.col("_metadata.file_name").rlike(name_regex))
        .select(path.alias("path"), F.col("value").alias("content"))
    )


def land_rows(
    documents: DataFrame, table_dir: str, checkpoint_dir: str, header_style: str = "snake"
) -> StreamingQuery:
    """Parse what is new into the row table at ``table_dir``, then stop."""
    return (
        table_rows(documents, header_style)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(table_dir)
    )
