"""From two folder trees to the longitudinal table, its dictionary and its run log."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.operators import collate as col
from scalargrid.operators import inventory as inv
from scalargrid.operators import metadata as meta
from scalargrid.operators import qc as quality
from scalargrid.operators import runlog as log
from scalargrid.operators.dictionary import data_dictionary
from scalargrid.operators.keyed import fits_broadcast
from scalargrid.operators.records import (
    DEFAULT_FORMATS,
    FILE_COLUMNS,
    BundleFormat,
    file_problems,
    layout_problems,
    parse_bundles,
)
from scalargrid.operators.sidecars import reduce_sidecars, sidecar_fields, sidecar_problems
from scalargrid.runtime import remove_dir, shared_dir, stage
from scalargrid.sources import files as src
from scalargrid.sources import sinks, versions
from scalargrid.sources.patterns import DATASET_DESCRIPTION, QC_PATTERNS, SIDECAR_PATTERNS, FilePattern
from scalargrid.sources.tables import table_rows

SESSIONS_TABLE = r"(?:^|_)sessions\.tsv$"
SCALAR_FORMATS = ("long", "wide")
MISSING_POLICIES = ("warn", "error", "ignore")


@dataclass(frozen=True)
class Outputs:
    """Lazy results of a job. ``work_dir`` holds their intermediate tables and can
    go once the results are written."""

    table: DataFrame
    run_log: DataFrame
    dictionary: DataFrame | None
    flag_counts: DataFrame
    work_dir: str


def _check(bundle_source, formats, scalar_format, policy, threshold_months, fd_threshold):
    problems = []
    if bundle_source != "auto" and bundle_source not in [f.name for f in formats]:
        problems.append(f"bundle_source {bundle_source!r} is not a known format")
    if scalar_format not in SCALAR_FORMATS:
        problems.append(f"scalar_format {scalar_format!r} is not one of {SCALAR_FORMATS}")
    if policy not in MISSING_POLICIES:
        problems.append(f"missing_session_policy {policy!r} is not one of {MISSING_POLICIES}")
    if threshold_months < 0:
        problems.append("infant_threshold_months must not be negative")
    if fd_threshold <= 0:
        problems.append("fd_threshold must be positive")
    if problems:
        raise ValueError("; ".join(problems))


def _any_name(regexes: Sequence[str]) -> str:
    return "|".join(f"(?:{r})" for r in regexes)


def _rows_of(
    texts: DataFrame, chosen: DataFrame,
    header_style: str = "snake", keep_empty: bool = False, first: int | None = None,
) -> DataFrame:
    """Row frame of the chosen files."""
    return table_rows(texts.join(chosen, "path"), header_style, keep_empty, first)


def build(
    spark: SparkSession,
    preproc_dir: str,
    recon_dir: str,
    group_dir: str | None = None,
    *,
    subjects: Sequence[str] | None = None,
    sessions: Sequence[str] | None = None,
    recon_suffixes: Sequence[str] | None = None,
    bundle_source: str = "auto",
    scalar_format: str = "long",
    infant_threshold_months: float = 18.0,
    expected_d_par: float = 1.7,
    fd_threshold: float = 0.5,
    missing_session_policy: str = "warn",
    include_qc: bool = True,
    include_data_dictionary: bool = True,
    drop_empty: bool = False,
    formats: Sequence[BundleFormat] = DEFAULT_FORMATS,
    expected_sessions: DataFrame | None = None,
    work_dir: str | None = None,
) -> Outputs:
    """Build all outputs. Sources are read once; what is used more than once
    (inventory, parsed rows, records, session metadata) is staged as a table.

    ``expected_sessions`` (``subject, session``) adds sessions that no file shows.
    """
    _check(bundle_source, formats, scalar_format, missing_session_policy,
           infant_threshold_months, fd_threshold)
    work_dir = work_dir or f"{shared_dir(spark).rstrip('/')}/scalargrid-{uuid.uuid4().hex}"

    # Files.
    preproc_globs = src.preproc_globs(preproc_dir, subjects)
    recon_globs = src.recon_globs(spark, recon_dir, subjects, recon_suffixes)
    trees = {"preproc": (preproc_dir, preproc_globs), "recon": (recon_dir, recon_globs)}
    listed = [
        inv.with_entities(
            src.list_files(spark, globs, folder=work_dir).withColumn("tree", F.lit(name)), src.plain_root(spark, root)
        )
        for name, (root, globs) in trees.items()
    ]
    found = stage(listed[0].unionByName(listed[1]), "inventory", work_dir)
    inside = found.where(F.col("subject").isNotNull())
    preproc = inv.keep_labels(
        inv.resolve_sessions(inside.where(F.col("tree") == "preproc"), folder=work_dir), subjects, sessions
    )
    recon = inv.keep_labels(
        inv.resolve_sessions(inside.where(F.col("tree") == "recon"), folder=work_dir),
        subjects, sessions, recon_suffixes,
    )
    patterns = [f.pattern for f in formats]
    recon_files = inv.classify_files(recon, patterns)
    bundle_files = stage(
        inv.pick_bundle_files(recon_files, bundle_source, work_dir).select(*FILE_COLUMNS, "source_type"),
        "bundle_files", work_dir,
    )
    sidecar_files = stage(
        inv.pick_sidecar_files(recon_files).select("path", *inv.SESSION_KEYS, "source_type"),
        "sidecar_files", work_dir,
    )
    texts = _texts(spark, trees, found, recon_files, bundle_files, patterns, include_qc, work_dir)
    members = preproc.select(*inv.SESSION_KEYS).unionByName(recon.select(*inv.SESSION_KEYS))
    if expected_sessions is not None:
        expected = expected_sessions.select(*inv.SESSION_KEYS)
        members = members.unionByName(inv.keep_labels(expected, subjects, sessions))
    cohort = stage(members.distinct(), "cohort", work_dir)
    cohort_subjects = inv.entity_values(cohort, "subject")
    cohort_sessions = inv.entity_values(cohort, "session")

    # Scalar records.
    rows = stage(
        _rows_of(texts["recon"], bundle_files),
        "rows", work_dir, partition_by="source_type",
    )
    records = stage(parse_bundles(rows, formats), "records", work_dir)
    problems = file_problems(rows).unionByName(layout_problems(rows))

    # Model sidecars.
    fields = stage(
        sidecar_fields(texts["recon"].join(sidecar_files, "path")), "sidecars", work_dir
    )

    # Quality control.
    qc_table = qc_files = None
    unusable = []
    if include_qc:
        qc_files = stage(
            inv.pick_qc_files(inv.classify_files(preproc, (), keep_others=True)), "qc_files", work_dir
        )
        qc_table, unusable = _qc(spark, texts["preproc"], qc_files, group_dir, fd_threshold, work_dir)

    # Ages and versions.
    age_rows = stage(
        _rows_of(
            texts["preproc"], inv.pick_age_files(inside.where(F.col("tree") == "preproc")), "lower"
        ),
        "age_rows", work_dir,
    )
    described = inv.pick_descriptions(found).select("path", "tree")
    descriptions = {
        name: frame.join(described.where(F.col("tree") == name), "path") for name, frame in texts.items()
    }
    session_info = stage(
        meta.add_versions(
            col.session_metadata(
                col.session_grid(cohort_subjects, cohort_sessions),
                reduce_sidecars(fields), qc_table, meta.session_ages(age_rows),
                infant_threshold_months, expected_d_par,
            ),
            descriptions["preproc"],
            descriptions["recon"],
        ),
        "sessions", work_dir,
    )

    # The table. Built-in formats keep the folder of each record, so their grid is closed;
    # of other formats only records of the cohort count.
    closed = all(f in DEFAULT_FORMATS for f in formats)
    table = col.collate(
        records, cohort_subjects, cohort_sessions, session_info, scalar_format,
        drop_empty=drop_empty, closed=closed,
    )
    missing = col.missing_sessions(records, cohort_subjects, cohort_sessions)
    if records.isEmpty():
        missing = missing.limit(0)
    gaps = col.apply_missing_policy(missing, missing_session_policy)

    # The run log.
    events = [
        log.file_events(
            bundle_files.join(problems, "path", "left_anti"), "bundle_scalar",
            order=F.struct("recon_suffix", "path"),
        ),
        log.file_events(
            sidecar_files.where(F.col("source_type") == "noddi"), "noddi_json",
            order=F.struct(F.lit("").alias("recon_suffix"), "path"),
        ),
    ]
    warnings = [
        log.warning_events(1, problems),
        log.warning_events(2, sidecar_problems(fields)),
        *(log.warning_events(3, frame) for frame in unusable),
        # A sessions table is about all sessions of its subject.
        log.warning_events(3, meta.age_problems(age_rows).drop("session").join(cohort, "subject")),
        log.warning_events(4, gaps),
    ]
    if qc_files is not None:
        for kind in ("qc", "confounds"):
            events.append(
                log.file_events(
                    qc_files, kind, f"{kind}_path",
                    F.struct(F.lit("").alias("recon_suffix"), F.lit("").alias("path")),
                )
            )
        warnings.append(log.warning_events(3, quality.qc_problems(qc_files)))
    run_log = log.run_log(log.union_events(*events), log.union_events(*warnings))

    return Outputs(
        table=table,
        run_log=run_log,
        dictionary=data_dictionary(table) if include_data_dictionary else None,
        flag_counts=col.flag_counts(table),
        work_dir=work_dir,
    )


def _texts(
    spark: SparkSession, trees: dict[str, tuple[str, list[str]]], found: DataFrame, recon_files: DataFrame,
    bundle_files: DataFrame, patterns: Sequence[FilePattern], include_qc: bool, work_dir: str,
) -> dict[str, DataFrame]:
    """Staged ``(path, content)`` per tree of what any step may want, also of files that cannot be read.

    One pass over each tree: file by file they would be listed again. Bundle tables that were not chosen are left
    out where their paths can be broadcast; beyond that they are copied too, so that no text is shuffled here.
    """
    wanted = {
        "preproc": [SESSIONS_TABLE, *(p.scan_regex for p in QC_PATTERNS if include_qc)],
        "recon": [p.scan_regex for p in (*patterns, *SIDECAR_PATTERNS)],
    }
    passed_over = stage(
        recon_files.where(F.col("category") == "bundle").select("path").join(bundle_files.select("path"), "path", "left_anti"),
        "passed_over", work_dir,
    )
    skip = fits_broadcast(passed_over)
    texts = {}
    for name, (_, globs) in trees.items():
        regex = _any_name([*wanted[name], f"^{re.escape(DATASET_DESCRIPTION)}$"])
        listed = found.where((F.col("tree") == name) & F.col("file_name").rlike(regex)).select("path", "file_size")
        without = passed_over if name == "recon" and skip else None
        if without is not None:
            listed = listed.join(without, "path", "left_anti")
        read = src.read_documents(spark, globs, regex, without, f"{name}_texts", work_dir)
        texts[name] = read.unionByName(stage(src.unread(read, listed), f"{name}_unread", work_dir))
    return texts


def _qc(
    spark: SparkSession, texts: DataFrame, qc_files: DataFrame,
    group_dir: str | None, fd_threshold: float, work_dir: str,
) -> tuple[DataFrame, list[DataFrame]]:
    """One row per session that has any quality-control data, and what could not be used."""
    def chosen(column: str) -> DataFrame:
        return qc_files.where(F.col(column).isNotNull()).select(
            *inv.SESSION_KEYS, F.col(column).alias("path")
        )

    image_rows = stage(_rows_of(texts, chosen("qc_path"), first=1), "qc_rows", work_dir)
    confound_rows = stage(
        _rows_of(texts, chosen("confounds_path"), "raw", keep_empty=True),
        "confound_rows", work_dir,
    )
    group = src.read_group_table(spark, group_dir) if group_dir else None
    metrics = quality.group_lookup(qc_files, group) if group is not None else None
    merged = quality.merge_qc(
        quality.image_qc(image_rows), quality.censoring_summary(confound_rows, fd_threshold), metrics
    )
    return merged, [
        quality.unusable_files(image_rows, "qc"), quality.unusable_files(confound_rows, "confounds")
    ]


def run(
    spark: SparkSession,
    preproc_dir: str,
    recon_dir: str,
    output_dir: str,
    group_dir: str | None = None,
    *,
    parquet: bool = False,
    sort: bool = False,
    keep_versions: int | None = None,
    **parameters,
) -> DataFrame:
    """Build all outputs, write them below ``output_dir``, return the primary table.

    With ``keep_versions`` they become a new version there, which ``sources.versions.published`` names
    once all of them are written; until then, and if the job fails, it names the former one.
    """
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep_versions must be at least 1")
    outputs = build(spark, preproc_dir, recon_dir, group_dir, **parameters)
    given = parameters.get("work_dir")
    target = output_dir if keep_versions is None else versions.new_version(output_dir)
    table = sinks.write_table(outputs.table, target, parquet, sort)
    if outputs.dictionary is not None:
        sinks.write_data_dictionary(outputs.dictionary, target)
    sinks.write_run_log(outputs.run_log, target)
    if keep_versions is not None:
        versions.publish(spark, target, keep_versions)
    if not parquet:
        table = sinks.read_table(table, target)
    if given is None:  # of no use any more: the primary table is read from its files
        remove_dir(spark, outputs.work_dir)
    return table
