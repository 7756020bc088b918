"""Session ages and dataset versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.cells import is_empty, name_cell, strip, to_number, with_label
from scalargrid.functions.sidecar_json import UNKNOWN_VERSION, dataset_version
from scalargrid.operators.inventory import SESSION_KEYS
from scalargrid.sources.patterns import RECON_FOLDER_PREFIX

# Names of the age and session columns, in order of trial.
AGE_COLUMNS = ("age_months", "age", "age_in_months")
SESSION_COLUMNS = ("session_id", "session", "ses")


def _first_named(header: Column, values: Column, names: tuple[str, ...]) -> Column:
    """Cell of the first name that the header has, even if the cell is empty."""
    cell: Column = F.lit(None).cast("string")
    for name in reversed(names):
        cell = F.when(F.array_contains(header, name), name_cell(header, values, name)).otherwise(cell)
    return cell


def session_ages(rows: DataFrame) -> DataFrame:
    """``(subject, session, session_age_months)`` from sessions tables.

    The last row of a session counts; an empty age there leaves it unknown,
    other text is skipped.
    """
    header, values = F.col("header"), F.col("values")
    age = _first_named(header, values, AGE_COLUMNS)
    label = strip(_first_named(header, values, SESSION_COLUMNS))
    return (
        rows.where(
            F.col("problem").isNull() & F.col("row").isNotNull()
            & F.exists("header", lambda c: c.isin(*AGE_COLUMNS))
        )
        .select("subject", with_label(label, "ses-").alias("session"), "row", age.alias("_cell"))
        .where(F.col("session").isNotNull())
        .withColumn("_age", to_number(F.col("_cell")))
        .where(F.col("_age").isNotNull() | is_empty(F.col("_cell")))
        .groupBy(*SESSION_KEYS)
        .agg(F.max_by("_age", "row").alias("session_age_months"))
    )


def age_problems(rows: DataFrame) -> DataFrame:
    """``(subject, session, path, message)`` of sessions tables that could not be read; no session is known."""
    return rows.where(F.col("problem").isNotNull()).select(
        "subject", F.lit(None).cast("string").alias("session"), "path",
        F.concat(F.lit("sessions_error:Could not read "), "path", F.lit(": "), "problem").alias("message"),
    )


def preproc_version(descriptions: DataFrame) -> Column:
    """Version of the preprocessing dataset, as a scalar subquery."""
    version = descriptions.agg(F.min_by(dataset_version(F.col("content")), "path")).scalar()
    return F.coalesce(version, F.lit(UNKNOWN_VERSION))


def recon_version(descriptions: DataFrame) -> Column:
    """First known version in the order of recon suffixes, as a scalar subquery."""
    suffix = F.regexp_extract("path", rf"(?:^|.*/){RECON_FOLDER_PREFIX}([^/]+)/", 1)
    known = descriptions.select(
        suffix.alias("_suffix"), dataset_version(F.col("content")).alias("_version")
    ).where(F.col("_version") != UNKNOWN_VERSION)
    version = known.agg(F.min_by("_version", "_suffix")).scalar()
    return F.coalesce(version, F.lit(UNKNOWN_VERSION))


def add_versions(
    df: DataFrame, preproc_descriptions: DataFrame, recon_descriptions: DataFrame
) -> DataFrame:
    """Two constant columns; no join, each subquery gives one value to the plan."""
    return df.withColumns(
        {
            "qsiprep_version": preproc_version(preproc_descriptions),
            "qsirecon_version": recon_version(recon_descriptions),
        }
    )
