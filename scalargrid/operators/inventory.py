"""Inventory of files: entities from paths, classification, choice of sources.

"First" and "preferred" are aggregates (``min`` of an ordered struct), not window
ranks: they combine on the map side, so a session or subject that owns most of
the files does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.cells import NO_SESSION, strip_label
from scalargrid.operators.keyed import KEY_ROWS, attach
from scalargrid.runtime import computed_once, stage, stored
from scalargrid.sources.patterns import (
    BUNDLE_PATTERNS,
    DATASET_DESCRIPTION,
    QC_PATTERNS,
    RECON_FOLDER_PREFIX,
    SIDECAR_PATTERNS,
    FilePattern,
)

SESSION_KEYS = ("subject", "session")


def extract_entities(
    df: DataFrame, column: str, pattern: str, names: Sequence[str]
) -> DataFrame:
    """Add one column per regex group of ``pattern``; NULL where a group is empty."""
    groups = [
        F.nullif(F.regexp_extract(column, pattern, i), F.lit("")).alias(name)
        for i, name in enumerate(names, start=1)
    ]
    return computed_once(df, groups)


def relative_path(path: Column, root: str) -> Column:
    """Part of a path below the folder ``root``, with or without a scheme; NULL outside of it."""
    def plain(text: Column) -> Column:
        return F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")

    top = F.concat(F.rtrim(plain(F.lit(root)), F.lit("/")), F.lit("/"))
    return F.when(F.startswith(plain(path), top), F.substr(plain(path), F.length(top) + 1))


def with_entities(files: DataFrame, root: str) -> DataFrame:
    """Add ``recon_suffix, subject, session, file_name, in_dwi`` from ``path``.

    Folders count by their place below ``root``: one of a workflow, perhaps in
    ``derivatives``, then one of a subject, then perhaps one of a session. Folders above the
    root or deeper inside mean nothing, whatever their names. ``session`` is NULL without a
    session folder. ``in_dwi`` tells whether the file lies directly in the ``dwi`` folder of its
    subject or session.
    """
    parts = F.split(relative_path(F.col("path"), root), "/")
    split = computed_once(files, [parts.alias("_parts")])
    start = F.when(F.get("_parts", F.lit(0)) == "derivatives", 1).otherwise(0)
    flow = F.startswith(F.get("_parts", F.col("_start")), F.lit(RECON_FOLDER_PREFIX))
    place = F.col("_start") + F.when(flow, 1).otherwise(0)

    def folder(at: Column, prefix: str) -> Column:
        name = F.get("_parts", at)
        return F.when(F.startswith(name, F.lit(prefix)) & (at < F.size("_parts") - 1), name)

    located = split.withColumn("_start", start).withColumn("_at", place).select(
        *files.columns, "_parts", "_at",
        F.coalesce(F.when(flow, F.substr(F.get("_parts", F.col("_start")), F.lit(len(RECON_FOLDER_PREFIX) + 1))), F.lit("unknown")).alias("recon_suffix"),
        folder(F.col("_at"), "sub-").alias("subject"), folder(F.col("_at") + 1, "ses-").alias("session"),
    )
    inner = F.col("_at") + F.when(F.col("session").isNotNull(), 2).otherwise(1)
    in_dwi = F.col("subject").isNotNull() & (F.get("_parts", inner) == "dwi") & (F.size("_parts") == inner + 2)
    session = F.when(F.col("subject").isNotNull(), F.col("session"))
    return located.select(
        *files.columns, "recon_suffix", "subject", session.alias("session"),
        F.substring_index("path", "/", -1).alias("file_name"), F.coalesce(in_dwi, F.lit(False)).alias("in_dwi"),
    )


def below_derivatives(files: DataFrame, root: str) -> DataFrame:
    """Keep what lies in the folder ``derivatives`` right below ``root`` if there is one, else all.

    Only that place counts: a folder of this name above the root or deeper inside means nothing.
    """
    nested = F.coalesce(F.startswith(relative_path(F.col("path"), root), F.lit("derivatives/")), F.lit(False))
    any_nested = files.agg(F.coalesce(F.bool_or(nested), F.lit(False))).first()[0]
    return files.where(nested) if any_nested else files


def resolve_sessions(
    files: DataFrame, by: Sequence[str] = ("recon_suffix", "subject"), folder: str | None = None
) -> DataFrame:
    """Settle the session of every file, per group of ``by`` (one subject folder).

    If the folder has any session folder, files outside of one are dropped;
    if it has none, they get the no-session label. One folder may hold most files.
    ``folder`` is where what is used twice is staged.
    """
    files = stored(files, "located", folder)
    layers = files.groupBy(*by).agg(F.bool_or(F.col("session").isNotNull()).alias("_layered"), F.count("*").alias(KEY_ROWS))
    return (
        attach(files, stage(layers, "layers", folder), by, ["_layered"])
        .where(F.col("session").isNotNull() | ~F.col("_layered"))
        .withColumn("session", F.coalesce("session", F.lit(NO_SESSION)))
        .select(*files.columns)
    )


def keep_labels(
    files: DataFrame,
    subjects: Sequence[str] | None = None,
    sessions: Sequence[str] | None = None,
    recon_suffixes: Sequence[str] | None = None,
) -> DataFrame:
    """Include-lists, labels without ``sub-``/``ses-``; empty or None keeps all."""
    if subjects:
        files = files.where(strip_label(F.col("subject"), "sub-").isin(*subjects))
    if sessions:
        files = files.where(strip_label(F.col("session"), "ses-").isin(*sessions))
    if recon_suffixes:
        files = files.where(F.col("recon_suffix").isin(*recon_suffixes))
    return files


def entity_values(files: DataFrame, column: str) -> DataFrame:
    """Distinct labels of one entity."""
    return files.select(column).where(F.col(column).isNotNull()).distinct()


def classify_files(
    files: DataFrame,
    bundle_patterns: Sequence[FilePattern] = BUNDLE_PATTERNS,
    keep_others: bool = False,
) -> DataFrame:
    """Add ``category, source_type, priority`` by file name.

    Other files are dropped, or kept with these columns NULL.
    """
    patterns = (*bundle_patterns, *SIDECAR_PATTERNS, *QC_PATTERNS)
    name = F.col("file_name")
    number = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns))):
        hit = F.endswith(name, F.lit(p.name_end))
        number = F.when(hit & name.rlike(p.name_regex) if p.name_regex else hit, i).otherwise(number)
    kinds = [
        F.get(F.lit([getattr(p, field) for p in patterns]), "_kind").alias(field)
        for field in ("category", "source_type", "priority")
    ]
    known = computed_once(files, [number.alias("_kind")])
    if not keep_others:
        known = known.where(F.col("_kind").isNotNull())
    return known.select(*files.columns, *kinds)


def pick_bundle_files(files: DataFrame, bundle_source: str = "auto", folder: str | None = None) -> DataFrame:
    """Bundle tables to parse.

    ``auto`` keeps all files of the best table type per recon folder, subject and
    session; a named type keeps that type only, with no fallback. One session may
    hold most files.
    """
    bundles = files.where((F.col("category") == "bundle") & F.col("in_dwi"))
    if bundle_source != "auto":
        return bundles.where(F.col("source_type") == bundle_source)
    keys = ["recon_suffix", *SESSION_KEYS]
    bundles = stored(bundles, "bundles", folder)
    best = bundles.groupBy(*keys).agg(F.min("priority").alias("_best"), F.count("*").alias(KEY_ROWS))
    return attach(bundles, stage(best, "best", folder), keys, ["_best"]).where(F.col("priority") == F.col("_best")).drop("_best")


def pick_sidecar_files(files: DataFrame) -> DataFrame:
    """Model sidecars of all recon folders, each path once."""
    return files.where((F.col("category") == "sidecar") & F.col("in_dwi")).dropDuplicates(["path"])


def pick_qc_files(files: DataFrame) -> DataFrame:
    """One row per session of the preprocessing tree:
    ``subject, session, era, qc_path, confounds_path, many_qc_files``.

    The current naming era wins over the legacy one, then the first path.
    Sessions with neither file are kept, so ``files`` should include those of no
    known kind: their folders count as sessions.
    """
    def when(category: str, era: str | None = None) -> Column:
        hit = (F.col("category") == category) & F.col("in_dwi")
        return hit if era is None else hit & (F.col("source_type") == era)

    first = F.struct("priority", "path")
    return (
        files.groupBy(*SESSION_KEYS)
        .agg(
            F.min(F.when(when("image_qc"), first)).alias("_qc"),
            F.min(F.when(when("confounds"), first)).alias("_confounds"),
            F.count_if(when("image_qc", "current")).alias("_current"),
            F.count_if(when("image_qc", "legacy")).alias("_legacy"),
        )
        .select(
            *SESSION_KEYS,
            F.when(F.col("_current") > 0, "current").when(F.col("_legacy") > 0, "legacy")
            .otherwise("unknown").alias("era"),
            F.col("_qc.path").alias("qc_path"),
            F.col("_confounds.path").alias("confounds_path"),
            F.when(F.col("_current") > 0, F.col("_current") > 1)
            .otherwise(F.col("_legacy") > 1).alias("many_qc_files"),
        )
    )


def pick_age_files(files: DataFrame) -> DataFrame:
    """``(subject, path)`` of the sessions table of each subject: its own name first."""
    own = F.col("file_name") == F.concat("subject", F.lit("_sessions.tsv"))
    plain = F.col("file_name") == "sessions.tsv"
    in_subject_folder = F.endswith("path", F.concat("subject", F.lit("/"), "file_name"))
    return (
        files.where(in_subject_folder & (own | plain))
        .groupBy("subject")
        .agg(F.min(F.struct(F.when(own, 0).otherwise(1).alias("rank"), "path")).alias("_first"))
        .select("subject", "_first.path")
    )


def pick_descriptions(files: DataFrame) -> DataFrame:
    """Dataset descriptions, one per dataset (outside of subject folders)."""
    return files.where((F.col("file_name") == DATASET_DESCRIPTION) & F.col("subject").isNull())
