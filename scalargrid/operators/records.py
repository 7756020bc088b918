"""Row frames -> scalar records ``subject, session, bundle, scalar, value, ...``.

Input rows carry the file columns ``path, subject, session, recon_suffix``.
Records keep ``path, row, column`` as their order within a session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.cells import (
    is_missing,
    normalise_bundle,
    null_if_nan,
    strip,
    stripped_number,
)

from scalargrid.functions.names import (
    canonical_scalar,
    is_shape_stat,
    scalar_from_file,
    source_from_file,
)
from scalargrid.runtime import computed_once, stored
from scalargrid.sources.patterns import BUNDLE_PATTERNS, FilePattern
from scalargrid.sources.tables import line_cells, line_heads

FILE_COLUMNS = ("path", "subject", "session", "recon_suffix")
ORDER_COLUMNS = ("recon_suffix", "path", "row", "column")
RECORD_SCHEMA = (
    "subject string, session string, bundle string, scalar string, scalar_raw string, "
    "value double, bundle_source string, recon_suffix string, is_shape_stat boolean, "
    "n_nodes long, path string, row long, column int"
)
RECORD_COLUMNS = tuple(f.split()[0] for f in RECORD_SCHEMA.split(", "))

# Names of the column that identifies the bundle, in order of trial.
BUNDLE_ID_COLUMNS = ("bundle_name", "tractname", "tract_name", "bundle", "name")
STATS_ID_COLUMNS = ("bundle", "tract_name", "bundle_name", "tractname")
TRACT_ID_COLUMNS = ("bundle_name", "tractname", "tract_name", "bundle", "name", "label")
# Parts of bundle names, and columns of a table of statistics.
BUNDLE_MARKS = ("left", "right", "_l", "_r", "ca", "fx", "mcp", "af", "cst", "ifo", "ilf")
STATS_MARKS = ("mean", "std", "bundle", "tract_name", "bundle_name")
# A column name that is a number, such as an index or a node position.
NUMERIC_NAME = r"^\s*-*[0-9.]*[0-9][0-9.]*\s*$"
BLANK_NAME = r"^unnamed:_\d+$"


def _file_name() -> Column:
    return F.substring_index("path", "/", -1)


def _usable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNull() & F.col("row").isNotNull())


def as_records(df: DataFrame) -> DataFrame:
    """Bring any frame with the record columns it knows to the record schema.

    A value that is not a number, or NaN, becomes NULL.
    """
    types = dict(f.split() for f in RECORD_SCHEMA.split(", "))
    columns = {
        c: (F.col(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind))
        for c, kind in types.items()
    }
    columns["value"] = null_if_nan(columns["value"])
    return df.select(*[column.alias(c) for c, column in columns.items()])


def bundle_id_position(header: Column) -> Column:
    """1-based position of the bundle column: first known name, else the first column."""
    return F.coalesce(
        *[F.nullif(F.array_position(header, c), F.lit(0)) for c in BUNDLE_ID_COLUMNS], F.lit(1)
    ).cast("int")


def bundle_table_records(rows: DataFrame, source_type: str | None = None) -> DataFrame:
    """Melt bundle tables: every numeric cell outside the id column is a record."""
    source = F.lit(source_type) if source_type else source_from_file(_file_name())
    cells = (
        _usable(rows)
        .withColumn("_id", bundle_id_position(F.col("header")))
        .withColumn("_bundle", F.get("values", F.col("_id") - 1))
        .where(~is_missing(F.col("_bundle")))
        .select(
            *FILE_COLUMNS, "row", "header", "_id",
            normalise_bundle(F.col("_bundle")).alias("bundle"),
            F.posexplode("values").alias("column", "_cell"),
        )
        .where(F.col("column") != F.col("_id") - 1)
        .withColumn("_cell", strip(F.col("_cell")))
    )
    cells = (
        computed_once(cells, [stripped_number(F.col("_cell")).alias("value")])
        .where(F.col("value").isNotNull())
        .withColumn("scalar_raw", F.get("header", "column"))
    )
    return as_records(
        cells.withColumn("scalar", canonical_scalar(F.col("scalar_raw")))
        .withColumn("is_shape_stat", is_shape_stat(F.col("scalar_raw")))
        .withColumn("bundle_source", source)
    )


def tract_layout(header: Column) -> Column:
    """``along_tract``, ``bundle_stats`` or NULL, from the column names of a table."""
    named = F.filter(
        header, lambda c: ~c.isin(*TRACT_ID_COLUMNS) & ~c.rlike(NUMERIC_NAME)
    )
    marks = "|".join(BUNDLE_MARKS)
    bundles = F.size(F.filter(named, lambda c: c.rlike(marks)))
    has_stats = F.arrays_overlap(header, F.array(*[F.lit(c) for c in STATS_MARKS]))
    return (
        F.when((bundles >= 2) | ((F.size(named) >= 2) & ~has_stats), "along_tract")
        .when(has_stats, "bundle_stats")
    )


def _scalar_base(scalar_name: str | None) -> Column:
    return F.lit(scalar_name) if scalar_name else scalar_from_file(_file_name())


def along_tract_records(rows: DataFrame, scalar_name: str | None = None) -> DataFrame:
    """Collapse node x bundle tables: mean, sample deviation and node count per bundle.

    The aggregate combines on the map side, so a long profile is never gathered.
    A bundle with one node keeps a record with an empty deviation.
    """
    nodes = (
        _usable(rows)
        .select(*FILE_COLUMNS, "values", F.posexplode("header").alias("column", "scalar_raw"))
        .withColumn("_text", strip(F.get("values", "column")))
        .withColumn("_node", stripped_number(F.col("_text")))
    )
    collapsed = nodes.groupBy(*FILE_COLUMNS, "column", "scalar_raw").agg(
        F.avg("_node").alias("mean"),
        F.stddev_samp("_node").alias("std"),
        F.count("_node").alias("n_nodes"),
    )
    return _collapsed_records(collapsed, scalar_name)


def node_moments(lines: DataFrame) -> DataFrame:
    """``path, column, n, mean, m2, cells`` of profiles that arrive line by line; ``m2`` is the sum of squared deviations.

    No header is needed, so lines are combined where they are read and never shuffled. What has been
    landed in increments is put together by ``merged_moments``; ``cells`` counts cells of any content.
    """
    nodes = computed_once(line_cells(lines), [strip(F.col("cell")).alias("_text")]).select(
        "path", "column", stripped_number(F.col("_text")).alias("_node")
    )
    return nodes.groupBy("path", "column").agg(
        F.count("_node").alias("n"), F.avg("_node").alias("mean"),
        (F.var_pop("_node") * F.count("_node")).alias("m2"), F.count("*").alias("cells"),
    )


def merged_moments(moments: DataFrame) -> DataFrame:
    """One row per path and column, from any number of parts, combined two by two in one order."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def combined(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = b["n"] / n
        return F.struct(
            n.alias("n"), (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
        )

    part = F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))
    return (
        moments.groupBy("path", "column")
        .agg(F.array_sort(F.collect_list(part)).alias("_parts"), F.sum("cells").alias("cells"))
        .select("path", "column", "cells", F.aggregate("_parts", none, combined).alias("_all"))
        .select("path", "column", F.col("_all.n").alias("n"), F.when(F.col("_all.n") > 0, F.col("_all.mean")).alias("mean"),
                F.when(F.col("_all.n") > 0, F.col("_all.m2")).alias("m2"), "cells")
    )


def moment_records(moments: DataFrame, heads: DataFrame, scalar_name: str | None = None) -> DataFrame:
    """Along-tract records from moments (one row per path and column) and the headers of the same files.

    A file with a row longer than its header is not used, as in ``line_rows``.
    """
    moments = stored(moments, "moments")
    width = moments.groupBy("path").agg(F.max("column").alias("_last"))
    known = heads.join(width, "path").where(F.col("_last") < F.size("header")).drop("_last")
    return _collapsed_records(
        moments.join(known, "path").select(
            *FILE_COLUMNS, "column", F.get("header", "column").alias("scalar_raw"), "mean",
            F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"), F.col("n").alias("n_nodes"),
        ),
        scalar_name,
    )


def tract_line_records(lines: DataFrame, scalar_name: str | None = None) -> DataFrame:
    """Along-tract records of tables in lines ``(path, row, line, subject, session, recon_suffix)``: two reads, no shuffle of lines."""
    return moment_records(node_moments(lines), line_heads(lines.select(*FILE_COLUMNS, "row", "line")), scalar_name)


def _collapsed_records(collapsed: DataFrame, scalar_name: str | None) -> DataFrame:
    # Index columns are told by name: one test per column, not one per node.
    index = F.col("scalar_raw").rlike(NUMERIC_NAME) | F.col("scalar_raw").rlike(BLANK_NAME)
    # Tied to an aggregate, so that the test stays above it.
    named = collapsed.where(F.when(index, 0).otherwise(F.col("n_nodes")) > 0)
    return as_records(
        named.select(
            *FILE_COLUMNS, "column", "scalar_raw", "n_nodes",
            F.posexplode(F.array("mean", "std")).alias("row", "value"),
        )
        .withColumn("bundle", normalise_bundle(F.col("scalar_raw")))
        .withColumn(
            "scalar",
            F.concat_ws("_", _scalar_base(scalar_name), F.when(F.col("row") == 0, "mean").otherwise("std")),
        )
        .withColumn("bundle_source", F.lit("tractometry"))
        .withColumn("is_shape_stat", F.lit(False))
    )


def bundle_stats_records(rows: DataFrame, scalar_name: str | None = None) -> DataFrame:
    """Melt the ``mean`` and ``std`` columns of per-bundle tables.

    An empty cell stays as a record without a value; other text is skipped.
    """
    known = F.transform("header", lambda c: c.isin(*STATS_ID_COLUMNS))
    cells = (
        _usable(rows)
        .withColumn("_id", F.greatest(F.array_position(known, True), F.lit(1)).cast("int"))
        .withColumn("_bundle", F.get("values", F.col("_id") - 1))
        .where(~is_missing(F.col("_bundle")))
        .select(
            *FILE_COLUMNS, "row", "values",
            normalise_bundle(F.col("_bundle")).alias("bundle"),
            F.posexplode("header").alias("column", "scalar_raw"),
        )
        .where(F.col("scalar_raw").isin("mean", "std"))
        .withColumn("_cell", strip(F.get("values", "column")))
    )
    cells = computed_once(cells, [stripped_number(F.col("_cell")).alias("value")]).where(
        F.col("value").isNotNull() | is_missing(F.col("_cell"))
    )
    return as_records(
        cells.withColumn("scalar", F.concat_ws("_", _scalar_base(scalar_name), "scalar_raw"))
        .withColumn("bundle_source", F.lit("tractometry"))
        .withColumn("is_shape_stat", F.lit(False))
    )


def tractometry_records(
    rows: DataFrame, scalar_name: str | None = None, layout: str | None = None
) -> DataFrame:
    """Records of tract tables; the layout is told by each header unless given."""
    if layout == "along_tract":
        return along_tract_records(rows, scalar_name)
    if layout == "bundle_stats":
        return bundle_stats_records(rows, scalar_name)
    told = _usable(rows).withColumn("_layout", tract_layout(F.col("header")))
    return along_tract_records(
        told.where(F.col("_layout") == "along_tract").drop("_layout"), scalar_name
    ).unionByName(
        bundle_stats_records(
            told.where(F.col("_layout") == "bundle_stats").drop("_layout"), scalar_name
        )
    )


class BundleFormat(NamedTuple):
    """A kind of bundle table: its place in the order of preference, its file
    names, and the function from its row frame to records."""

    name: str
    priority: int
    file_regex: str | None
    parse: Callable[[DataFrame], DataFrame]
    file_end: str = ""

    @property
    def pattern(self) -> FilePattern:
        return FilePattern("bundle", self.name, self.priority, self.file_end, self.file_regex)


_PARSERS = {
    "bundle_means": lambda rows: bundle_table_records(rows, None),
    "scalarstats": lambda rows: bundle_table_records(rows, None),
    "tractometry": tractometry_records,
}
DEFAULT_FORMATS = tuple(
    BundleFormat(p.source_type, p.priority, p.name_regex, _PARSERS[p.source_type], p.name_end)
    for p in BUNDLE_PATTERNS
)


def register_format(
    name: str,
    priority: int,
    file_regex: str,
    parse: Callable[[DataFrame], DataFrame],
    formats: Sequence[BundleFormat] = DEFAULT_FORMATS,
) -> tuple[BundleFormat, ...]:
    """The formats with one more; a format of the same name is replaced.

    ``parse`` gets the row frame of the files chosen for the format and returns
    at least ``subject, session, bundle, scalar, value``.
    """
    others = [f for f in formats if f.name != name]
    added = BundleFormat(name, priority, file_regex, parse)
    return tuple(sorted([*others, added], key=lambda f: f.priority))


def parse_bundles(
    rows: DataFrame, formats: Sequence[BundleFormat] = DEFAULT_FORMATS
) -> DataFrame:
    """Records of all formats, from a row frame with a ``source_type`` column."""
    result = None
    for fmt in formats:
        part = as_records(
            fmt.parse(rows.where(F.col("source_type") == fmt.name).drop("source_type"))
        ).withColumn("bundle_source", F.coalesce("bundle_source", F.lit(fmt.name)))
        result = part if result is None else result.unionByName(part)
    return result


def file_problems(rows: DataFrame) -> DataFrame:
    """``(subject, session, path, message)`` of the tables that could not be used."""
    return rows.where(F.col("problem").isNotNull()).select(
        "subject", "session", "path",
        F.concat(
            F.lit("parse_error:"), _file_name(), F.lit(":Could not read "), "path",
            F.lit(": "), "problem",
        ).alias("message"),
    )


def layout_problems(rows: DataFrame) -> DataFrame:
    """``(subject, session, path, message)`` of tract tables whose header shows no known layout."""
    tracts = rows.where((F.col("source_type") == "tractometry") & F.col("problem").isNull())
    return tracts.where(tract_layout(F.col("header")).isNull()).select(
        "subject", "session", "path",
        F.concat(F.lit("parse_error:"), _file_name(), F.lit(":Unrecognised tract table layout")).alias("message"),
    ).distinct()
