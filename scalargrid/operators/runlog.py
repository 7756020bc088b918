"""Run log: which files were used and what went wrong, one row per session."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.operators.inventory import SESSION_KEYS

FILE_TYPES = ("bundle_scalar", "qc", "confounds", "noddi_json")


def file_events(files: DataFrame, file_type: str | Column, path: str = "path",
                order: str | Column = "path") -> DataFrame:
    """``(subject, session, file_type, path, order)``; a NULL path records an absence."""
    kind = F.lit(file_type) if isinstance(file_type, str) else file_type
    by = F.col(order) if isinstance(order, str) else order
    return files.select(
        *SESSION_KEYS, kind.alias("file_type"), F.col(path).alias("path"), by.alias("order")
    )


def warning_events(step: int, warnings: DataFrame) -> DataFrame:
    """``(subject, session, step, path, message)``: warnings in the order of the steps."""
    return warnings.select(*SESSION_KEYS, F.lit(step).alias("step"), "path", "message")


def union_events(*events: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), events)


def log_status(bundle_file: Column, qc_file: Column, warned: Column) -> Column:
    """``ok`` needs both files and no warning; one file is ``partial``, none ``missing``."""
    both = bundle_file.isNotNull() & qc_file.isNotNull()
    either = bundle_file.isNotNull() | qc_file.isNotNull()
    return F.when(both & ~warned, "ok").when(either, "partial").otherwise("missing")


def run_log(files: DataFrame, warnings: DataFrame) -> DataFrame:
    """Last file per type and all warnings, for every session that has either.

    Each side is reduced to one row per session before they meet, so the join
    moves sessions, not events. The text of a session's warnings is one output
    cell by definition and holds all of them.
    """
    last = [
        F.max_by("path", F.when(F.col("file_type") == kind, F.col("order"))).alias(f"_{kind}")
        for kind in FILE_TYPES
    ]
    by_file = files.groupBy(*SESSION_KEYS).agg(*last)
    by_warning = warnings.groupBy(*SESSION_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("step", "path", "message"))).alias("_events")
    )
    texts = F.transform("_events", lambda e: e["message"])
    warned = F.col("_events").isNotNull()

    def text(kind: str) -> Column:
        return F.coalesce(f"_{kind}", F.lit(""))

    return by_file.join(by_warning, list(SESSION_KEYS), "full").select(
        *SESSION_KEYS,
        log_status(F.col("_bundle_scalar"), F.col("_qc"), warned).alias("status"),
        text("bundle_scalar").alias("bundle_scalar_file"),
        text("qc").alias("qc_file"),
        text("confounds").alias("confounds_file"),
        F.col("_noddi_json").isNotNull().alias("noddi_json_found"),
        F.coalesce(F.array_join(texts, "|"), F.lit("")).alias("warnings"),
    )
