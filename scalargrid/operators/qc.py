"""Quality control: image metrics, censoring counts, group metrics, one row per session."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.cells import (
    NO_SESSION,
    is_missing,
    name_cell,
    share,
    strip_label,
    to_number,
)
from scalargrid.operators.inventory import SESSION_KEYS
from scalargrid.sources.files import ROW_ORDER

# Column of an image-QC file -> column of the output. Where two
# columns share a target, the later one wins if the file has it.
IMAGE_QC_COLUMNS = {
    "mean_fd": "qc_mean_fd",
    "max_fd": "qc_max_fd",
    "raw_neighbor_corr": "qc_ndc_raw",
    "t1_neighbor_corr": "qc_ndc",
    "raw_num_bad_slices": "qc_num_bad_slices_raw",
    "t1_num_bad_slices": "qc_num_bad_slices",
    "max_translation": "qc_max_translation",
    "max_rotation": "qc_max_rotation",
    "max_rel_translation": "qc_max_rel_translation",
    "max_rel_rotation": "qc_max_rel_rotation",
    "t1_dice_distance": "qc_t1_dice_distance",
    "mni_dice_distance": "qc_mni_dice_distance",
    "neighbor_corr": "qc_ndc",
    "num_bad_slices": "qc_num_bad_slices",
}
# Displacement column, and id columns of the group table.
DISPLACEMENT_COLUMN = "framewise_displacement"
GROUP_ID_COLUMNS = ("subject_id", "session_id", "bids_name", "task_id", "run_id")
GROUP_PREFIX = "mriqc_"


def _row_values(header: Column, values: Column) -> list[Column]:
    targets: dict[str, Column] = {}
    for raw, target in IMAGE_QC_COLUMNS.items():
        value = to_number(name_cell(header, values, raw))
        earlier = targets.get(target)
        targets[target] = (
            value if earlier is None
            else F.when(F.array_contains(header, raw), value).otherwise(earlier)
        )
    return [value.alias(target) for target, value in targets.items()]


def image_qc(rows: DataFrame) -> DataFrame:
    """Metrics of the first row of the image-QC file of each session."""
    known = F.array(*[F.lit(c) for c in IMAGE_QC_COLUMNS])
    return (
        rows.where(
            F.col("problem").isNull() & F.col("row").isNotNull()
            & F.arrays_overlap("header", known)
        )
        .groupBy(*SESSION_KEYS)
        .agg(F.min_by(F.struct("header", "values"), "row").alias("_first"))
        .select(*SESSION_KEYS, *_row_values(F.col("_first.header"), F.col("_first.values")))
    )


def censoring_summary(
    rows: DataFrame, threshold: float = 0.5, column: str = DISPLACEMENT_COLUMN
) -> DataFrame:
    """Volumes, volumes above the threshold, and their share, per session.

    A missing displacement counts as a volume that is not censored. Files
    without the column give no row; files without volumes give zero volumes.
    """
    fd = to_number(name_cell(F.col("header"), F.col("values"), column))
    return (
        rows.where(F.col("problem").isNull() & F.array_contains("header", column))
        .select(*SESSION_KEYS, "row", fd.alias("_fd"))
        .groupBy(*SESSION_KEYS)
        .agg(
            F.count("row").alias("qc_n_volumes"),
            F.count_if(F.col("_fd") > threshold).alias("qc_n_censored"),
        )
        .select(
            *SESSION_KEYS, "qc_n_volumes", "qc_n_censored",
            share(F.col("qc_n_censored"), F.col("qc_n_volumes")).alias("qc_pct_censored"),
            F.lit(float(threshold)).alias("qc_fd_threshold_used"),
        )
    )


def group_metrics(table: DataFrame, numeric: Sequence[str] | None = None) -> list[Column]:
    """Prefixed metric columns; DOUBLE where every present cell is a number.

    Without ``numeric`` one aggregate over the table finds those columns.
    """
    metrics = [c for c in table.columns if c not in (*GROUP_ID_COLUMNS, ROW_ORDER)]
    if numeric is None and metrics:
        checks = table.agg(
            *[
                F.bool_and(is_missing(F.col(f"`{c}`")) | to_number(F.col(f"`{c}`")).isNotNull())
                .alias(str(i))
                for i, c in enumerate(metrics)
            ]
        ).first()
        numeric = [c for c, ok in zip(metrics, checks) if ok is not False]
    return [
        (to_number(F.col(f"`{c}`")) if c in numeric
         else F.when(~is_missing(F.col(f"`{c}`")), F.col(f"`{c}`"))).alias(GROUP_PREFIX + c)
        for c in metrics
    ]


def group_lookup(
    spine: DataFrame, table: DataFrame, numeric: Sequence[str] | None = None
) -> DataFrame:
    """First matching row of the group table for each session of ``spine``.

    Rows match on the subject id, else on the subject token of ``bids_name``,
    else all match; and on the session id where the table has one and the
    session has a label. ``table`` has text cells and an ordering column ``_row_order``.
    """
    subject = session = None
    if "subject_id" in table.columns:
        subject = strip_label(F.col("subject_id"), "sub-")
    elif "bids_name" in table.columns:
        subject = F.regexp_extract("bids_name", r"sub-([^_]+)(?:_|$)", 1)
    if "session_id" in table.columns:
        session = strip_label(F.col("session_id"), "ses-")

    metrics = F.struct(*group_metrics(table, numeric))
    keyed = table.select(
        *([subject.alias("_subject")] if subject is not None else []),
        *([session.alias("_session")] if session is not None else []),
        F.col(ROW_ORDER).alias("row"),
        metrics.alias("_metrics"),
    )
    keys = [c for c in keyed.columns if c in ("_subject", "_session")]
    firsts = keyed.groupBy(*keys).agg(
        F.min_by("_metrics", "row").alias("_metrics"), F.min("row").alias("row")
    )
    sessions = spine.select(
        *SESSION_KEYS,
        strip_label(F.col("subject"), "sub-").alias("_subject"),
        strip_label(F.col("session"), "ses-").alias("_session"),
    )
    if session is not None:
        rest = [c for c in keys if c != "_session"]
        any_session = firsts.groupBy(*rest).agg(
            F.min_by("_metrics", "row").alias("_metrics"), F.min("row").alias("row")
        )
        firsts = firsts.where(F.col("_session") != NO_SESSION).unionByName(
            any_session.withColumn("_session", F.lit(NO_SESSION))
        )
    if keys:
        matched = sessions.join(firsts, keys)
    else:
        matched = sessions.withColumn("_metrics", firsts.select("_metrics").scalar())
    return matched.where(F.col("_metrics").isNotNull()).select(*SESSION_KEYS, "_metrics.*")


def merge_qc(*frames: DataFrame | None) -> DataFrame:
    """One QC row per session that has any; each frame has one row per session."""
    present = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.join(b, list(SESSION_KEYS), "full"), present)


def qc_problems(chosen: DataFrame) -> DataFrame:
    """``(subject, session, path, message)`` where several image-QC files matched."""
    return chosen.where("many_qc_files").select(
        *SESSION_KEYS, F.col("qc_path").alias("path"),
        F.concat(F.lit("multiple_qc_files:using "), F.substring_index("qc_path", "/", -1))
        .alias("message"),
    )


def unusable_files(rows: DataFrame, kind: str) -> DataFrame:
    """``(subject, session, path, message)`` of quality files that could not be read."""
    return rows.where(F.col("problem").isNotNull()).select(
        *SESSION_KEYS, "path", F.concat(F.lit(f"{kind}_error:Could not read "), "path", F.lit(": "), "problem").alias("message")
    )
