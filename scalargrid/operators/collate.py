"""The longitudinal table: complete grid, session metadata, wide form.

The grid is the product of four label sets. Records are not shuffled to meet it:
the table is *records + gaps*, where gaps are the grid keys without any record.
Only distinct keys travel, so a key with very many records costs no more than
any other.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.flags import NO_MODEL_DATA, assumption_flag
from scalargrid.operators.inventory import SESSION_KEYS
from scalargrid.operators.records import ORDER_COLUMNS
from scalargrid.runtime import AXIS_LIMIT, distinct_values, small_values, stored

LONG_KEYS = ("subject", "session", "bundle", "scalar")
BUNDLE_KEYS = ("subject", "session", "bundle")

# Columns that come first in the output, in this order.
PRIORITY_COLUMNS = (
    "subject", "session", "bundle", "scalar", "value", "scalar_present",
    "recon_suffix", "bundle_source",
    "noddi_d_par", "noddi_d_par_flag", "noddi_d_iso", "noddi_modulated_present",
    "qc_mean_fd", "qc_max_fd", "qc_ndc", "qc_num_bad_slices",
    "qc_n_volumes", "qc_n_censored", "qc_pct_censored",
)
# Columns of a record that its bundle row in the wide table does not keep.
CELL_COLUMNS = ("scalar", "value", "scalar_raw", "is_shape_stat", "scalar_present")


class MissingSessionError(RuntimeError):
    """A session without scalar data under the ``error`` policy."""


def expand_axis(
    df: DataFrame, axis: DataFrame, column: str, limit: int = AXIS_LIMIT
) -> DataFrame:
    """Repeat every row of ``df`` once per distinct value of ``axis[column]``.

    Up to ``limit`` values travel in the plan as an array and are exploded in
    place. A longer axis is dealt out by hash into slices of about ``limit`` values
    that meet the rows by an equality join on the slice number, so that no side is
    broadcast or collected, and rows are copied once per slice only.
    """
    values = small_values(axis, column, limit)
    if values is not None:
        return _explode_values(df, column, values)
    distinct = axis.select(column).where(F.col(column).isNotNull()).distinct()
    parts = -(-distinct.count() // max(1, limit))
    dealt = distinct.withColumn(
        "_slice", F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")
    )
    repeated = df.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return repeated.join(dealt, "_slice").drop("_slice")


def _values_literal(values: Sequence[str]) -> Column:
    # As JSON the list reaches the plan in one piece, where it is folded to an array.
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def _explode_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.withColumn(column, F.explode(_values_literal(values)))


def session_grid(subjects: DataFrame, sessions: DataFrame, limit: int = AXIS_LIMIT) -> DataFrame:
    """Every subject with every session label of the cohort."""
    subjects = subjects.select("subject").where(F.col("subject").isNotNull()).distinct()
    return expand_axis(subjects, sessions, "session", limit)


def _in_cohort(records: DataFrame, subjects: DataFrame, sessions: DataFrame) -> DataFrame:
    """Records of the subjects and sessions of the grid; others are dropped."""
    return records.join(subjects.select("subject").distinct(), "subject", "left_semi").join(
        sessions.select("session").distinct(), "session", "left_semi"
    )


def complete_grid(
    records: DataFrame,
    subjects: DataFrame,
    sessions: DataFrame,
    limit: int = AXIS_LIMIT,
    closed: bool = False,
) -> DataFrame:
    """Records on the full subject x session x bundle x scalar grid.

    Duplicate keys keep all their rows. ``scalar_present`` is false, and all
    other columns are NULL, where the grid has no record. ``closed`` says that
    every record is known to belong to a listed subject and session, which
    saves two joins.
    """
    records = stored(records, "records")
    found = records if closed else _in_cohort(records, subjects, sessions)
    bundles = expand_axis(session_grid(subjects, sessions, limit), records, "bundle", limit)
    names = small_values(records, "scalar", limit)
    present = found.select(*LONG_KEYS).where(F.col("scalar").isNotNull())
    if names is None:
        gaps = expand_axis(bundles, records, "scalar", limit).join(
            present.distinct(), list(LONG_KEYS), "left_anti"
        )
    else:
        # A bundle's scalars are a set of at most ``limit`` names: what is missing follows in place.
        sets = present.groupBy(*BUNDLE_KEYS).agg(F.collect_set("scalar").alias("_present"))
        missing = F.array_except(_values_literal(names), F.coalesce("_present", F.array().cast("array<string>")))
        gaps = bundles.join(sets, list(BUNDLE_KEYS), "left").select(
            *BUNDLE_KEYS, F.explode(missing).alias("scalar")
        )
    return (
        found.withColumn("scalar_present", F.lit(True))
        .unionByName(gaps.withColumn("scalar_present", F.lit(False)), allowMissingColumns=True)
    )


def first_by(column: str, order: Column) -> Column:
    """First non-null value of a column in an explicit order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), order))


def order_of(df: DataFrame, order: Sequence[str] = ORDER_COLUMNS) -> Column:
    present = [c for c in order if c in df.columns]
    return F.col(present[0]) if len(present) == 1 else F.struct(*present)


def wide_table(
    records: DataFrame,
    scalars: Sequence[str] | None = None,
    order: Sequence[str] = ORDER_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per bundle, one column per scalar; first value per cell by ``order``.

    ``keep`` names record columns that are reduced to their first non-null value.
    Without ``scalars`` the distinct names are looked up first; there may be any number.

    Records combine to one row per cell before the shuffle; kept columns come from a second
    aggregate and meet the cells by equal keys, NULL keys included.
    """
    if scalars is None:
        scalars = distinct_values(records, "scalar")
    by = order_of(records, order)
    kept = [first_by(c, by).alias(c) for c in keep]
    if not scalars:
        return records.groupBy(*BUNDLE_KEYS).agg(*kept) if kept else records.select(*BUNDLE_KEYS).distinct()
    values = records.groupBy(*BUNDLE_KEYS).pivot("scalar", list(scalars)).agg(first_by("value", by))
    if not kept:
        return values
    firsts = records.groupBy(*BUNDLE_KEYS).agg(*kept).select(
        *(F.col(c).alias(f"_{c}") for c in BUNDLE_KEYS), *(F.col(f"`{c}`") for c in keep)
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in BUNDLE_KEYS]
    return values.join(firsts, same).drop(*(f"_{c}" for c in BUNDLE_KEYS))


def complete_wide(
    records: DataFrame,
    subjects: DataFrame,
    sessions: DataFrame,
    scalars: Sequence[str] | None = None,
    order: Sequence[str] = ORDER_COLUMNS,
    keep: Sequence[str] = (),
    drop_empty: bool = False,
    limit: int = AXIS_LIMIT,
    closed: bool = False,
) -> DataFrame:
    """Wide table with a row for every subject x session x bundle.

    ``drop_empty`` leaves out rows and scalars without any value. The scalar axis is
    never expanded: only three-key rows are completed.
    """
    records = stored(records, "records")
    found = records if closed else _in_cohort(records, subjects, sessions)
    if drop_empty:
        names = scalars or distinct_values(records.where(F.col("value").isNotNull()), "scalar")
        wide = wide_table(found, names, order, keep)
        return wide.dropna("all", subset=names) if names else wide
    wide = wide_table(found, scalars or distinct_values(records, "scalar"), order, keep)
    grid = expand_axis(session_grid(subjects, sessions, limit), records, "bundle", limit)
    return grid.join(wide, list(BUNDLE_KEYS), "left")


def keep_first(df: DataFrame, order: Sequence[str], keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """One row per key: the first in an explicit order."""
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), by).alias("_row"))
        .select(*keys, "_row.*")
    )


def session_metadata(
    spine: DataFrame,
    sidecars: DataFrame | None = None,
    qc: DataFrame | None = None,
    ages: DataFrame | None = None,
    infant_threshold_months: float = 18.0,
    expected_d_par: float = 1.7,
) -> DataFrame:
    """All session-level columns on one row per session, flag included.

    Ages are attached before the flag is set. Doing this per session leaves a
    single join with the large table, and flags are set once per session instead
    of once per cell.
    """
    result = spine.select(*SESSION_KEYS)
    for frame in (sidecars, qc, ages):
        if frame is not None:
            result = result.join(frame, list(SESSION_KEYS), "left")
    if ages is None:
        result = result.withColumn("session_age_months", F.lit(None).cast("double"))
    return add_flag(fill_flags(result), infant_threshold_months, expected_d_par)


def fill_flags(df: DataFrame) -> DataFrame:
    """Unknown booleans count as false."""
    names = [c for c in ("scalar_present", "noddi_modulated_present") if c in df.columns]
    return df.withColumns({c: F.coalesce(c, F.lit(False)) for c in names}) if names else df


def add_flag(
    df: DataFrame, infant_threshold_months: float = 18.0, expected_d_par: float = 1.7
) -> DataFrame:
    """Add ``noddi_d_par_flag``; one constant text when there is no such parameter."""
    if "noddi_d_par" not in df.columns:
        return df.withColumn("noddi_d_par_flag", F.lit(NO_MODEL_DATA))
    age = (
        F.col("session_age_months") if "session_age_months" in df.columns
        else F.lit(None).cast("double")
    )
    return df.withColumn(
        "noddi_d_par_flag",
        assumption_flag(F.col("noddi_d_par"), age, infant_threshold_months, expected_d_par),
    )


def broadcast_sessions(table: DataFrame, *frames: DataFrame) -> DataFrame:
    """Attach frames with one row per session to every row of that session.

    No side is forced to be broadcast: Spark does so below its own size limit. Beyond it a
    session that owns most rows is split only where ``frame`` is a stored table, so that both
    sides of the join come straight from a shuffle; ``build`` stores it.
    """
    for frame in frames:
        table = table.join(frame, list(SESSION_KEYS), "left")
    return table


def reorder_columns(df: DataFrame, first: Sequence[str] = PRIORITY_COLUMNS) -> DataFrame:
    """Priority columns that exist, then all others in place."""
    leading = [c for c in dict.fromkeys(first) if c in df.columns]
    rest = [c for c in df.columns if c not in leading]
    return df.select(*[F.col(f"`{c}`") for c in (*leading, *rest)])


def missing_sessions(records: DataFrame, subjects: DataFrame, sessions: DataFrame,
                     limit: int = AXIS_LIMIT) -> DataFrame:
    """Sessions of the grid without a single record."""
    return session_grid(subjects, sessions, limit).join(
        records.select(*SESSION_KEYS).distinct(), list(SESSION_KEYS), "left_anti"
    )


def apply_missing_policy(missing: DataFrame, policy: str = "warn") -> DataFrame:
    """Warnings ``(subject, session, path, message)`` for missing sessions.

    ``error`` raises on the first one, ``ignore`` gives no rows.
    """
    if policy not in ("warn", "error", "ignore"):
        raise ValueError(f"unknown missing-session policy {policy!r}")
    if policy == "error":
        hit = missing.orderBy(*SESSION_KEYS).take(1)
        if hit:
            raise MissingSessionError(
                f"No scalar data found for {hit[0]['subject']} {hit[0]['session']}"
            )
    warnings = missing.select(
        *SESSION_KEYS, F.lit(None).cast("string").alias("path"),
        F.lit("no_scalar_data").alias("message"),
    )
    return warnings if policy == "warn" else warnings.limit(0)


def flag_counts(df: DataFrame) -> DataFrame:
    """Rows per audit flag."""
    return df.groupBy("noddi_d_par_flag").agg(F.count(F.lit(1)).alias("n_rows"))


def collate(
    records: DataFrame,
    subjects: DataFrame,
    sessions: DataFrame,
    metadata: DataFrame | None = None,
    scalar_format: str = "long",
    drop_empty: bool = False,
    order: Sequence[str] = ORDER_COLUMNS,
    closed: bool = False,
    limit: int = AXIS_LIMIT,
) -> DataFrame:
    """The primary table, long or wide, with session-level columns attached."""
    hidden = ("path", "row", "column")
    if scalar_format == "long":
        table = complete_grid(records, subjects, sessions, limit, closed).drop(*hidden)
        if metadata is not None:
            table = broadcast_sessions(table, metadata)
        return reorder_columns(table)
    if scalar_format != "wide":
        raise ValueError(f"unknown scalar format {scalar_format!r}")
    keep = [c for c in records.columns if c not in (*BUNDLE_KEYS, *CELL_COLUMNS, *hidden)]
    table = complete_wide(
        records, subjects, sessions, None, order, keep, drop_empty, limit, closed
    )
    scalars = [c for c in table.columns if c not in (*BUNDLE_KEYS, *keep)]
    if metadata is not None:
        table = broadcast_sessions(table, metadata)
    return reorder_columns(table, (*BUNDLE_KEYS, *scalars, *PRIORITY_COLUMNS))
