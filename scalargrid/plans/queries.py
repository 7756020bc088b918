"""One query per operator over the whole benchmark tables, each with its SQL equal.

A query is registered under its function name; the SQL is the argument of the
decorator.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.operators import collate as col
from scalargrid.operators import inventory as inv
from scalargrid.operators import metadata as meta
from scalargrid.operators import qc as quality
from scalargrid.operators import records as rec
from scalargrid.operators import runlog as log
from scalargrid.operators import sidecars as side
from scalargrid.operators.dictionary import data_dictionary
from scalargrid.plans import inputs, job, trees
from scalargrid.plans.inputs import BUNDLE_RECORDS_SQL, SIDECARS_SQL, table
from scalargrid.runtime import remove_dir, shared_dir, stage
from scalargrid.sources import files as src
from scalargrid.sources import sinks
from scalargrid.sources.tables import line_rows, table_cells, table_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# Melting tables ---------------------------------------------------------------


def _bundle_records(spark: SparkSession, sf_dir: str, withhold: bool = False) -> DataFrame:
    """Records parsed from the bundle documents; some sessions may be left out."""
    documents = inputs.bundle_documents(spark, sf_dir)
    if withhold:
        documents = documents.where("(s + y) % 10 <> 0")
    return rec.bundle_table_records(table_rows(documents.drop("s", "y", "source_type")))


_RECORD_COLUMNS = (
    "subject", "session", "bundle", "scalar", "scalar_raw", "value", "bundle_source",
    "recon_suffix", "is_shape_stat",
)


@query(f"WITH {BUNDLE_RECORDS_SQL} SELECT {', '.join(_RECORD_COLUMNS)} FROM records")
def melt_scalars(spark, sf_dir):
    """Header-polymorphic tables to records: names, numbers, shape tags, empty cells."""
    return _bundle_records(spark, sf_dir).select(*_RECORD_COLUMNS)


@query("""
    SELECT 'sub-' || p_partkey AS subject, CAST(1 AS BIGINT) AS row, CAST(c AS INTEGER) AS "column",
           CASE c WHEN 0 THEN 'part_name' WHEN 1 THEN 'note' WHEN 2 THEN 'size' ELSE 'size.1' END AS name,
           CASE c WHEN 0 THEN p_name || ' 5" ' || p_size
                  WHEN 1 THEN p_brand || ', "' || p_type || '"' || chr(10) || chr(57344)
                  WHEN 2 THEN CAST(p_size AS VARCHAR) END AS cell
    FROM part, range(4) AS r(c)""")
def quoted_cells(spark, sf_dir):
    """Quoted separators and line breaks, stray quotes, repeated names, short rows, CRLF."""
    documents = table(spark, sf_dir, "part").selectExpr(
        "concat('sub-', p_partkey) as subject", "concat('/d/', p_partkey, '.csv') as path",
        r'''concat('\ufeff Part Name ,note,size,size\r\n\r\n', p_name, ' 5" ', p_size, ',"', p_brand,
                   ', ""', p_type, '""\n\ue000",', p_size, '\r\n') as content''',
    )
    return table_cells(table_rows(documents)).drop("path")


@query(f"""
    WITH {BUNDLE_RECORDS_SQL}
    SELECT 'parse_error:sub-' || s || '_bundle_means.tsv' AS file,
           count(*) AS n_sessions FROM (SELECT DISTINCT s, y FROM totals WHERE s % 5 = 1) GROUP BY s""")
def file_problems(spark, sf_dir):
    """Tables that cannot be used become warnings and the job goes on."""
    documents = inputs.bundle_documents(spark, sf_dir).selectExpr(
        "subject", "session", "concat('/d/', y, '/', subject, '_bundle_means.tsv') as path",
        r"if(s % 5 = 1, concat(content, '\nx\t1\t2\t3\t4\t5'), replace(content, ',', '\t')) as content",
    )
    problems = rec.file_problems(table_rows(documents))
    return problems.groupBy(
        F.regexp_extract("message", r"^(.*?tsv):", 1).alias("file")
    ).agg(F.count(F.lit(1)).alias("n_sessions"))


@query("""
    SELECT p_partkey,
           CASE p_size % 6 WHEN 0 THEN 'along_tract' WHEN 1 THEN 'bundle_stats'
                WHEN 2 THEN 'along_tract' WHEN 3 THEN NULL WHEN 4 THEN 'bundle_stats'
                ELSE 'along_tract' END AS layout
    FROM part""")
def tract_layout(spark, sf_dir):
    """Layout of a tract table, told by its header alone."""
    header = F.expr("""split(case p_size % 6
        when 0 then 'unnamed:_0,af_left,cst_right' when 1 then 'bundle,mean,std'
        when 2 then 'label,0,tract_a,tract_b' when 3 then 'name,1,-2.5,value'
        when 4 then 'tract_name,value' else 'mean,cst_a,fx_b' end, ',')""")
    return table(spark, sf_dir, "part").select(
        "p_partkey", rec.tract_layout(header).alias("layout")
    )


@query("""
    WITH nodes AS (
      SELECT l_suppkey AS s, year(l_shipdate) AS y, 'af_left' AS bundle, 'af_left' AS scalar_raw,
             l_quantity AS v FROM lineitem
      UNION ALL SELECT l_suppkey, year(l_shipdate), 'cst_right', 'cst-right',
                       round(l_discount * 100) FROM lineitem
      UNION ALL SELECT l_suppkey, year(l_shipdate), 'ifo_r', 'ifo_r',
                       CASE WHEN l_linenumber <> 3 THEN round(l_tax * 100) END FROM lineitem),
    collapsed AS (
      SELECT s, y, bundle, scalar_raw, avg(v) AS m, stddev_samp(v) AS d, count(v) AS n
      FROM nodes GROUP BY ALL HAVING count(v) > 0)
    SELECT 'sub-' || s AS subject, 'ses-' || y AS session, 'W' || (s % 3) AS recon_suffix, bundle,
           scalar_raw, scalar, round(CASE scalar WHEN 'fa_mean' THEN m ELSE d END, 8) AS value,
           n AS n_nodes
    FROM collapsed, (VALUES ('fa_mean'), ('fa_std')) AS x(scalar)""")
def along_tract_collapse(spark, sf_dir):
    """Node-by-bundle tables, read line by line, to mean, deviation and node count."""
    records = rec.tract_line_records(inputs.tract_lines(spark, sf_dir))
    return records.select(
        "subject", "session", "recon_suffix", "bundle", "scalar_raw", "scalar",
        F.round("value", 8).alias("value"), "n_nodes",
    )


@query(f"""
    WITH {BUNDLE_RECORDS_SQL},
    stats AS (
      SELECT s, y, lower(f) AS bundle, 'md_mean' AS scalar, q AS value FROM totals WHERE f <> 'A'
      UNION ALL SELECT s, y, lower(f), 'md_std', CASE WHEN y % 3 = 2 THEN d END
      FROM totals WHERE f <> 'A' AND y % 3 <> 1)
    SELECT 'sub-' || s AS subject, 'ses-' || y AS session, bundle, scalar, value FROM stats""")
def per_bundle_stats(spark, sf_dir):
    """Tables of means and deviations; empty cells stay, other text goes."""
    records = rec.tractometry_records(table_rows(inputs.stats_documents(spark, sf_dir)))
    return records.select("subject", "session", "bundle", "scalar", "value")


@query(f"""
    WITH {BUNDLE_RECORDS_SQL}
    SELECT bundle_source, scalar, count(*) AS n_records, round(sum(value), 2) AS total FROM (
      SELECT bundle_source, scalar, value FROM records
      UNION ALL
      SELECT 'sizes', 'content_length', CAST(length(p_name) AS DOUBLE) FROM part)
    GROUP BY ALL""")
def registered_format(spark, sf_dir):
    """All formats in one frame, one of them registered by the user."""
    formats = rec.register_format(
        "sizes", 9, r"_sizes\.csv$",
        lambda rows: rows.select(
            "subject", "session", F.lit("all").alias("bundle"),
            F.lit("content_length").alias("scalar"),
            F.length(F.get("values", F.lit(0))).cast("double").alias("value"),
        ),
    )
    sizes = table(spark, sf_dir, "part").selectExpr(
        "concat('/d/', p_partkey, '_sizes.csv') as path", "concat('sub-', p_partkey) as subject",
        "'ses-1' as session", "'X' as recon_suffix", "'sizes' as source_type",
        r"concat('name\n', p_name) as content",
    )
    documents = inputs.bundle_documents(spark, sf_dir).drop("s", "y").unionByName(sizes)
    return (
        rec.parse_bundles(table_rows(documents), formats)
        .groupBy("bundle_source", "scalar")
        .agg(F.count(F.lit(1)).alias("n_records"), F.round(F.sum("value"), 2).alias("total"))
    )


# Collation --------------------------------------------------------------------

_GRID_SQL = f"""
    WITH {BUNDLE_RECORDS_SQL},
    kept AS (SELECT * FROM records WHERE (s + y) % 10 <> 0),
    grid AS (
      SELECT * FROM (SELECT DISTINCT 'sub-' || l_suppkey AS subject FROM lineitem)
      CROSS JOIN (SELECT DISTINCT 'ses-' || year(l_shipdate) AS session FROM lineitem)
      CROSS JOIN (SELECT DISTINCT bundle FROM kept) CROSS JOIN (SELECT DISTINCT scalar FROM kept)),
    long AS (
      SELECT g.*, k.value, k.recon_suffix, k.scalar_raw, k.bundle_source, k.is_shape_stat,
             k.subject IS NOT NULL AS scalar_present
      FROM grid g LEFT JOIN kept k USING (subject, session, bundle, scalar))"""


@query(f"{_GRID_SQL} SELECT * EXCLUDE (scalar_raw, bundle_source, is_shape_stat) FROM long")
def complete_grid(spark, sf_dir):
    """Every subject x session x bundle x scalar, gaps marked."""
    records = _bundle_records(spark, sf_dir, withhold=True).select(
        *col.LONG_KEYS, "value", "recon_suffix"
    )
    return col.complete_grid(records, *inputs.cohort_axes(spark, sf_dir), closed=True)


@query(f"{_GRID_SQL} SELECT * EXCLUDE (scalar_raw, bundle_source, is_shape_stat) FROM long")
def complete_grid_long_axes(spark, sf_dir):
    """The same grid when no axis is short enough to travel in the plan."""
    records = _bundle_records(spark, sf_dir, withhold=True).select(
        *col.LONG_KEYS, "value", "recon_suffix"
    )
    return col.complete_grid(records, *inputs.cohort_axes(spark, sf_dir), limit=0)


_WIDE_SQL = f"""{_GRID_SQL},
    wide AS (
      SELECT subject, session, bundle,
             max(value) FILTER (WHERE scalar = 'fa_mean') AS fa_mean,
             max(value) FILTER (WHERE scalar = 'fa_std') AS fa_std,
             max(value) FILTER (WHERE scalar = 'length_mean') AS length_mean,
             max(value) FILTER (WHERE scalar = 'qa_mean') AS qa_mean,
             max(value) FILTER (WHERE scalar = 'volume') AS volume,
             max(recon_suffix) AS recon_suffix
      FROM long GROUP BY ALL)"""


@query(f"{_WIDE_SQL} SELECT * FROM wide")
def complete_wide(spark, sf_dir):
    """Wide table with a row for every subject x session x bundle."""
    return col.complete_wide(
        _bundle_records(spark, sf_dir, withhold=True), *inputs.cohort_axes(spark, sf_dir),
        keep=["recon_suffix"],
    )


@query(f"{_WIDE_SQL} SELECT * FROM wide WHERE recon_suffix IS NOT NULL")
def observed_wide(spark, sf_dir):
    """Wide table without the rows that have no value."""
    return col.complete_wide(
        _bundle_records(spark, sf_dir, withhold=True), *inputs.cohort_axes(spark, sf_dir),
        keep=["recon_suffix"], drop_empty=True,
    )


@query("""
    WITH r AS (
      SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session,
             lower(o_orderstatus) AS bundle, 'p' || substr(o_orderpriority, 1, 1) AS scalar,
             CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS value, o_orderkey AS i,
             CASE WHEN o_orderkey % 5 <> 0 THEN 'W' || (o_orderkey % 3) END AS recon_suffix
      FROM orders)
    SELECT subject, session, bundle,
           arg_min(value, i) FILTER (WHERE scalar = 'p1') AS p1,
           arg_min(value, i) FILTER (WHERE scalar = 'p2') AS p2,
           arg_min(value, i) FILTER (WHERE scalar = 'p3') AS p3,
           arg_min(value, i) FILTER (WHERE scalar = 'p4') AS p4,
           arg_min(value, i) FILTER (WHERE scalar = 'p5') AS p5,
           arg_min(recon_suffix, i) AS recon_suffix
    FROM r GROUP BY ALL""")
def wide_pivot(spark, sf_dir):
    """Scalars as columns, first value per cell and first metadata in an explicit order."""
    records = table(spark, sf_dir, "orders").selectExpr(
        "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
        "lower(o_orderstatus) as bundle", "concat('p', left(o_orderpriority, 1)) as scalar",
        "if(o_orderkey % 17 = 0, null, o_totalprice) as value", "o_orderkey",
        "if(o_orderkey % 5 = 0, null, concat('W', o_orderkey % 3)) as recon_suffix",
    )
    return col.wide_table(records, order=["o_orderkey"], keep=["recon_suffix"])


@query(f"""{_GRID_SQL}
    SELECT subject, session FROM long GROUP BY ALL
    HAVING count(*) FILTER (WHERE scalar_present) = 0""")
def missing_sessions(spark, sf_dir):
    """Sessions of the grid without any record, as warnings of the run log."""
    missing = col.missing_sessions(
        _bundle_records(spark, sf_dir, withhold=True), *inputs.cohort_axes(spark, sf_dir)
    )
    return col.apply_missing_policy(missing, "warn").select("subject", "session")


@query("""
    WITH o AS (SELECT *, 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session
               FROM orders)
    SELECT o_orderkey, o.subject, o.session, s.noddi_d_par, q.qc_mean_fd
    FROM o
    LEFT JOIN (SELECT subject, session, arg_min(o_totalprice, o_orderkey) AS noddi_d_par
               FROM o WHERE o_orderkey % 2 = 0 GROUP BY ALL) s USING (subject, session)
    LEFT JOIN (SELECT subject, session, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS qc_mean_fd
               FROM o WHERE o_orderkey % 3 = 0 GROUP BY ALL) q USING (subject, session)""")
def session_broadcast(spark, sf_dir):
    """Sidecar and quality columns on every row of their session; first duplicate wins."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderdate", "o_totalprice",
        "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
    )
    sidecars = col.keep_first(orders.where("o_orderkey % 2 = 0"), ["o_orderkey"])
    qc = col.keep_first(orders.where("o_orderkey % 3 = 0"), ["o_orderdate", "o_orderkey"])
    return col.broadcast_sessions(
        orders.select("o_orderkey", "subject", "session"),
        sidecars.selectExpr("subject", "session", "o_totalprice as noddi_d_par"),
        qc.selectExpr("subject", "session", "o_totalprice as qc_mean_fd"),
    )


@query("""
    SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session,
           o_orderstatus AS bundle, o_orderpriority AS scalar, o_totalprice AS value,
           o_totalprice / 2 AS qc_ndc, o_orderkey AS extra
    FROM orders""")
def column_order(spark, sf_dir):
    """Priority columns first, the rest in place."""
    frame = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as extra", "o_totalprice / 2 as qc_ndc", "o_totalprice as value",
        "o_orderpriority as scalar", "o_orderstatus as bundle",
        "concat('ses-', year(o_orderdate)) as session", "concat('sub-', o_custkey) as subject",
    )
    return col.reorder_columns(frame)


# Inventory --------------------------------------------------------------------

_PATHS_SQL = """
    paths AS (
      SELECT '/data/sub-study/recon/' || CASE WHEN o_orderkey % 4 < 2 THEN 'derivatives/' ELSE '' END
             || 'qsirecon-' || o_orderstatus || '/sub-' || o_custkey || '/'
             || CASE WHEN o_custkey % 3 = 0 OR o_orderkey % 10 = 0 THEN ''
                     ELSE 'ses-' || year(o_orderdate) || '/' END
             || CASE o_orderkey % 12 WHEN 5 THEN 'anat' WHEN 7 THEN 'dwi/sub-1_work' ELSE 'dwi' END
             || '/' AS folder,
             o_orderstatus AS recon_suffix, 'sub-' || o_custkey AS subject,
             CASE WHEN o_custkey % 3 <> 0 AND o_orderkey % 10 <> 0
                  THEN 'ses-' || year(o_orderdate) END AS found_session,
             o_orderkey % 12 NOT IN (5, 7) AS in_dwi, o_orderkey, o_orderpriority
      FROM orders),
    files AS (
      SELECT * EXCLUDE (found_session, layered), coalesce(found_session, '_no_session') AS session
      FROM (SELECT *, bool_or(found_session IS NOT NULL)
                        OVER (PARTITION BY recon_suffix, subject) AS layered
            FROM paths WHERE folder LIKE '%/derivatives/%')
      WHERE found_session IS NOT NULL OR NOT layered)"""


def _located(files: DataFrame) -> DataFrame:
    """The root branch first, then the session layer of each subject in it."""
    located = stage(inv.with_entities(files, inputs.RECON_ROOT), "located")
    return inv.resolve_sessions(inv.below_derivatives(located, inputs.RECON_ROOT))


@query(f"""
    WITH {_PATHS_SQL}
    SELECT folder || 'f' || o_orderkey || '.json' AS path, recon_suffix, subject, session,
           'f' || o_orderkey || '.json' AS file_name, in_dwi
    FROM files""")
def path_entities(spark, sf_dir):
    """Entities from paths, the root branch, and the session layer of each subject."""
    return _located(inputs.order_files(spark, sf_dir, "'f', o_orderkey, '.json'"))


@query(f"""
    WITH {_PATHS_SQL}
    SELECT DISTINCT recon_suffix, subject, session FROM files
    WHERE recon_suffix IN ('F', 'O') AND session IN ('ses-1996', 'ses-1998', '_no_session')
      AND right(subject, 1) IN ('1', '5') AND length(subject) = 6""")
def path_filters(spark, sf_dir):
    """Include-lists of subjects, sessions and workflows."""
    files = _located(inputs.order_files(spark, sf_dir, "'f', o_orderkey, '.json'"))
    listed = [str(n) for n in range(10, 100) if n % 10 in (1, 5)]
    return inv.keep_labels(files, listed, ["1996", "1998", "_no_session"], ["F", "O"]).select(
        "recon_suffix", "subject", "session"
    ).distinct()


@query("""
    SELECT nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/([0-9]+)', 1), '') AS host,
           nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/([0-9]+)', 2), '') AS lang,
           nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/([0-9]+)', 3), '') AS number, page_id
    FROM pages""")
def url_entities(spark, sf_dir):
    """Entities from any path-like text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return inv.extract_entities(
        pages, "url", r"^https?://([^/]+)/([a-z]{2})/([0-9]+)", ["host", "lang", "number"]
    ).drop("url")


_KINDS_SQL = f"""{_PATHS_SQL},
    kinds AS (
      SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS priority,
             CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'bundle_means'
                  WHEN '2' THEN 'scalarstats' WHEN '3' THEN 'tractometry' END AS source_type
      FROM files WHERE in_dwi)"""


def _bundle_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.order_files(spark, sf_dir, """o_orderkey, case left(o_orderpriority, 1)
        when '1' then '_bundle_means.tsv' when '2' then '_bundles-A_scalarstats.csv'
        when '3' then '_Tractometry_FA.csv' when '4' then '_dwi.json' else '_means.tsv' end""")
    return inv.classify_files(_located(files))


@query(f"""
    WITH {_KINDS_SQL}
    SELECT recon_suffix, subject, session, source_type, o_orderkey FROM (
      SELECT *, dense_rank() OVER (PARTITION BY recon_suffix, subject, session
                                   ORDER BY priority) AS rank
      FROM kinds WHERE source_type IS NOT NULL)
    WHERE rank = 1""")
def priority_source(spark, sf_dir):
    """All files of the best table type per workflow, subject and session."""
    return inv.pick_bundle_files(_bundle_inventory(spark, sf_dir)).select(
        "recon_suffix", "subject", "session", "source_type",
        F.regexp_extract("file_name", r"^(\d+)_", 1).cast("long").alias("o_orderkey"),
    )


@query(f"""
    WITH {_KINDS_SQL}
    SELECT recon_suffix, subject, session, o_orderkey FROM kinds WHERE source_type = 'scalarstats'""")
def named_source(spark, sf_dir):
    """Files of one table type, without fallback."""
    return inv.pick_bundle_files(_bundle_inventory(spark, sf_dir), "scalarstats").select(
        "recon_suffix", "subject", "session",
        F.regexp_extract("file_name", r"^(\d+)_", 1).cast("long").alias("o_orderkey"),
    )


@query(f"""
    WITH {_PATHS_SQL},
    qc AS (
      SELECT subject, coalesce(found_session, '_no_session') AS session, in_dwi,
             o_orderkey % 6 AS kind, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS name
      FROM (SELECT *, bool_or(found_session IS NOT NULL) OVER (PARTITION BY subject) AS layered
            FROM paths)
      WHERE found_session IS NOT NULL OR NOT layered)
    SELECT subject, session,
           CASE WHEN bool_or(in_dwi AND kind = 0) THEN 'current'
                WHEN bool_or(in_dwi AND kind = 1) THEN 'legacy' ELSE 'unknown' END AS era,
           coalesce(min(name) FILTER (WHERE in_dwi AND kind = 0),
                    min(name) FILTER (WHERE in_dwi AND kind = 1)) AS qc_name,
           coalesce(min(name) FILTER (WHERE in_dwi AND kind = 2),
                    min(name) FILTER (WHERE in_dwi AND kind = 3)) AS confounds_name,
           CASE WHEN bool_or(in_dwi AND kind = 0) THEN count(*) FILTER (WHERE in_dwi AND kind = 0) > 1
                ELSE count(*) FILTER (WHERE in_dwi AND kind = 1) > 1 END AS many_qc_files
    FROM qc GROUP BY ALL""")
def era_fallback(spark, sf_dir):
    """First quality files of each session: current names, then legacy ones."""
    files = inputs.order_files(spark, sf_dir, """lpad(o_orderkey, 12, '0'), case o_orderkey % 6
        when 0 then '_desc-image_qc.tsv' when 1 then '_desc-ImageQC_dwi.csv'
        when 2 then '_desc-confounds_timeseries.tsv' when 3 then '_confounds.tsv'
        else '_dwi.nii.gz' end""")
    located = inv.resolve_sessions(
        inv.with_entities(files.selectExpr(
            "regexp_replace(path, '^.*/qsirecon-[^/]+/', '/data/preproc/') as path"
        ), "/data/preproc"), by=["subject"],
    )
    chosen = inv.pick_qc_files(inv.classify_files(located, (), keep_others=True))
    name = r"([0-9]{12})_[^/]*$"
    return chosen.select(
        "subject", "session", "era",
        F.regexp_extract("qc_path", name, 1).alias("qc_name"),
        F.regexp_extract("confounds_path", name, 1).alias("confounds_name"),
        "many_qc_files",
    )


@query("""
    SELECT 'sub-' || o_custkey AS subject,
           '/data/preproc/sub-' || o_custkey || '/'
           || CASE WHEN bool_or(o_orderkey % 7 = 0) THEN 'sub-' || o_custkey || '_' ELSE '' END
           || 'sessions.tsv' AS path
    FROM orders GROUP BY o_custkey HAVING bool_or(o_orderkey % 7 <= 1)""")
def age_files(spark, sf_dir):
    """The sessions table of each subject: its own name, else the plain one."""
    files = table(spark, sf_dir, "orders").selectExpr(
        """concat('/data/preproc/sub-', o_custkey, '/', case o_orderkey % 7
             when 0 then concat('sub-', o_custkey, '_sessions.tsv') when 1 then 'sessions.tsv'
             when 2 then 'dwi/sessions.tsv' else 'notes.tsv' end) as path"""
    )
    return inv.pick_age_files(inv.with_entities(files, "/data/preproc"))


@query(f"""
    WITH {_PATHS_SQL}
    SELECT 'subject' AS entity, subject AS label FROM files
    UNION SELECT 'session', session FROM files UNION SELECT 'recon_suffix', recon_suffix FROM files""")
def entity_values(spark, sf_dir):
    """Distinct subjects, sessions and workflows."""
    files = _located(inputs.order_files(spark, sf_dir, "'f', o_orderkey, '.json'"))
    return log.union_events(*[
        inv.entity_values(files, c).select(F.lit(c).alias("entity"), F.col(c).alias("label"))
        for c in ("subject", "session", "recon_suffix")
    ])


@query(f"""
    WITH {_PATHS_SQL}
    SELECT folder || 'f' || o_orderkey || name AS path, subject, session, source_type
    FROM files JOIN (VALUES (0, '_model-noddi_param-od_dwimap.json', 'noddi'),
                            (1, '_model-noddi_desc-modulated_param-icvf_dwimap.json', 'noddi'),
                            (2, '_model-tensor_param-md_dwimap.json', 'tensor')) AS n(k, name, source_type)
      ON o_orderkey % 4 = k
    WHERE in_dwi""")
def sidecar_files(spark, sf_dir):
    """Model sidecars of all workflows, each path once however often it is listed."""
    files = inputs.order_files(spark, sf_dir, """'f', o_orderkey, case o_orderkey % 4
        when 0 then '_model-noddi_param-od_dwimap.json'
        when 1 then '_model-noddi_desc-modulated_param-icvf_dwimap.json'
        when 2 then '_model-tensor_param-md_dwimap.json' else '_model-noddi_param-fa_dwimap.json' end""")
    located = inv.classify_files(_located(files.unionAll(files)))
    return inv.pick_sidecar_files(located).select("path", "subject", "session", "source_type")


@query("""
    SELECT '/d/sub-top/' || CASE s_suppkey % 4 WHEN 0 THEN '' ELSE 'derivatives/qsirecon-' || s_suppkey || '/' END
           || 'dataset_description.json' AS path,
           CASE s_suppkey % 4 WHEN 0 THEN 'unknown' ELSE CAST(s_suppkey AS VARCHAR) END AS recon_suffix
    FROM supplier WHERE s_suppkey % 4 <= 1""")
def description_files(spark, sf_dir):
    """Descriptions of data sets: outside of subject folders, below a root of any name."""
    files = table(spark, sf_dir, "supplier").selectExpr(
        """concat('/d/sub-top/', case s_suppkey % 4 when 0 then '' when 1 then concat('derivatives/qsirecon-', s_suppkey, '/')
                  when 2 then concat('derivatives/qsirecon-', s_suppkey, '/sub-', s_suppkey, '/')
                  else concat('sub-', s_suppkey, '/ses-1/') end, 'dataset_description.json') as path"""
    )
    return inv.pick_descriptions(inv.with_entities(files, "/d/sub-top")).select("path", "recon_suffix")


@query("""
    WITH o AS (SELECT o_orderkey AS i, 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session FROM orders)
    SELECT subject, session, kind, count(*) AS n_files FROM (
      SELECT subject, session, 'qc_error' AS kind FROM o WHERE i % 3 = 0
      UNION ALL SELECT subject, session, 'confounds_error' FROM o WHERE i % 3 = 1
      UNION ALL SELECT subject, NULL, 'sessions_error' FROM o WHERE i % 5 = 0
      UNION ALL SELECT subject, session, 'parse_error' FROM o WHERE i % 7 < 3
      UNION ALL SELECT subject, session, 'dwimap_json_error' FROM o WHERE i % 2 = 0)
    GROUP BY ALL""")
def source_problems(spark, sf_dir):
    """Unusable files of every kind become warnings: quality, motion, ages, layouts, JSON."""
    def documents(content: str, name: str) -> DataFrame:
        return table(spark, sf_dir, "orders").selectExpr(
            "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
            "'W' as recon_suffix", "'tractometry' as source_type",
            f"concat('/d/', o_orderkey, '{name}') as path", f"{content} as content",
        )

    wide_row = r"concat('framewise_displacement\n1', if({}, '\t2', ''), '\n')"
    qc = table_rows(documents(wide_row.format("o_orderkey % 3 = 0"), "_desc-image_qc.tsv"))
    motion = table_rows(documents(wide_row.format("o_orderkey % 3 = 1"), "_confounds.tsv"), "raw")
    ages = table_rows(documents(r"if(o_orderkey % 5 = 0, '\n \n', 'age\n1\n')", "_sessions.tsv"), "lower")
    tracts = table_rows(documents(
        r"if(o_orderkey % 7 < 3, 'thing\n1\n', 'a_left,b_right\n1,2\n')", "_tractometry.csv"))
    fields = side.sidecar_fields(documents("if(o_orderkey % 2 = 0, '[1', '{\"d_par\": 1.7}')", "_model-noddi_param-od_dwimap.json"))
    found = log.union_events(
        quality.unusable_files(qc, "qc"), quality.unusable_files(motion, "confounds"), meta.age_problems(ages),
        rec.layout_problems(tracts), side.sidecar_problems(fields),
    )
    return found.groupBy("subject", "session", F.substring_index("message", ":", 1).alias("kind")).agg(
        F.count("*").alias("n_files")
    )


@query("""
    SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session, o_orderstatus AS bundle,
           'x' || o_orderkey AS scalar, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS value,
           o_orderpriority AS note, format, true AS in_order
    FROM orders, (VALUES ('csv'), ('parquet')) AS f(format)
    UNION ALL
    SELECT 'sub-' || o_custkey, 'ses-' || year(o_orderdate), NULL, NULL, NULL, max(o_orderpriority), 'log', true
    FROM orders GROUP BY o_custkey, year(o_orderdate)
    UNION ALL
    SELECT NULL, NULL, NULL, 'x', NULL, 'Auto-documented column: x', 'dictionary', true""")
def written_tables(spark, sf_dir):
    """Sorted primary table as CSV and Parquet, dictionary and run log, written and read back."""
    folder = f"{shared_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    records = table(spark, sf_dir, "orders").selectExpr(
        "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
        "o_orderstatus as bundle", "concat('x', o_orderkey) as scalar",
        "if(o_orderkey % 5 = 0, null, o_totalprice) as value", "o_orderpriority as note",
    )
    sinks.write_table(records, folder, parquet=True, sort=True)
    sinks.write_data_dictionary(data_dictionary(spark.createDataFrame([], "x string")), folder)
    sinks.write_run_log(
        log.run_log(
            log.file_events(records.withColumnRenamed("note", "path"), "qc"),
            log.warning_events(1, records.limit(0).selectExpr("subject", "session", "note as path", "note as message")),
        ), folder,
    )
    key = F.struct(*col.LONG_KEYS)
    back = {"csv": sinks.read_table(records, folder), "parquet": spark.read.parquet(f"{folder}/{sinks.TABLE_NAME}.parquet")}
    frames = []
    for name, frame in back.items():
        # Part files are in order: none begins before the one ahead of it ends.
        parts = frame.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("a"), F.max(key).alias("b"))
        rows = sorted(map(tuple, parts.collect()))
        ordered = all(one[2] <= two[1] for one, two in zip(rows, rows[1:]))
        frames.append(frame.withColumns({"format": F.lit(name), "in_order": F.lit(ordered)}))
    logged = spark.read.option("header", True).option("sep", "\t").csv(f"{folder}/{sinks.RUN_LOG_NAME}.tsv").selectExpr(
        "subject", "session", "string(null) as bundle", "string(null) as scalar", "double(null) as value",
        "qc_file as note", "'log' as format", "true as in_order")
    listed = spark.read.option("header", True).csv(f"{folder}/{sinks.DICTIONARY_NAME}.csv").selectExpr(
        "string(null) as subject", "string(null) as session", "string(null) as bundle", "column_name as scalar",
        "double(null) as value", "description as note", "'dictionary' as format", "true as in_order")
    return log.union_events(*frames, logged, listed)


# Sidecars ---------------------------------------------------------------------


@query(f"WITH {SIDECARS_SQL} SELECT * FROM sidecars")
def sidecar_reduce(spark, sf_dir):
    """Model parameters per session: key aliases, first value, counts, bad JSON."""
    return side.reduce_sidecars(side.sidecar_fields(inputs.sidecar_documents(spark, sf_dir)))


@query("""
    WITH f AS (
      SELECT p_partkey AS i, 'sub-' || p_brand AS subject, p_partkey % 7 <> 0 AS readable,
             CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS method FROM part)
    SELECT subject, 'ses-1' AS session, count(*) AS dti_sidecar_count,
           first(method ORDER BY i) FILTER (WHERE readable) AS dti_fitting_method
    FROM f GROUP BY subject""")
def fitting_method(spark, sf_dir):
    """Fitting method of the first readable sidecar, even if it names none."""
    documents = table(spark, sf_dir, "part").selectExpr(
        "concat('sub-', p_brand) as subject", "'ses-1' as session",
        """concat('/d/', lpad(p_partkey, 12, '0'), '_model-tensor_param-md_dwimap.json') as path""",
        """case when p_partkey % 7 = 0 then '[1' when p_partkey % 3 = 0 then '{"Model": "tensor"}'
                when p_partkey % 2 = 0 then concat('{"method": "', p_type, '"}')
                else concat('{"method": "x", "FittingMethod": "', p_type, '"}') end as content""",
    )
    return side.reduce_sidecars(side.sidecar_fields(documents)).select(
        "subject", "session", "dti_sidecar_count", "dti_fitting_method"
    )


# Quality control --------------------------------------------------------------


@query("""
    SELECT 'sub-' || user_id AS subject, 'ses-' || event_type AS session,
           count(*) AS qc_n_volumes,
           count(*) FILTER (WHERE value > 40 AND event_id % 11 <> 0) AS qc_n_censored,
           round(count(*) FILTER (WHERE value > 40 AND event_id % 11 <> 0) / count(*), 6)
             AS qc_pct_censored,
           CAST(40 AS DOUBLE) AS qc_fd_threshold_used
    FROM events GROUP BY ALL""")
def censoring_summary(spark, sf_dir):
    """Volumes above the displacement threshold, from time series read by line."""
    rows = line_rows(inputs.motion_lines(spark, sf_dir), "raw")
    return quality.censoring_summary(rows, 40.0)


@query("""
    WITH q AS (
      SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session, o_orderkey AS i,
             o_totalprice AS fd, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey / 2 END AS ndc,
             o_custkey % 2 = 0 AS legacy
      FROM orders)
    SELECT subject, session, first(fd ORDER BY i) AS qc_mean_fd,
           CAST(NULL AS DOUBLE) AS qc_max_fd,
           first(CASE WHEN legacy THEN ndc ELSE fd END ORDER BY i) AS qc_ndc
    FROM q GROUP BY ALL""")
def first_row_qc(spark, sf_dir):
    """Image metrics of the first row, legacy column names first."""
    rows = inputs.order_rows(
        spark, sf_dir,
        "if(o_custkey % 2 = 0, array('mean_fd', 't1_neighbor_corr', 'neighbor_corr'), "
        "array('mean_fd', 't1_neighbor_corr', 'other'))",
        "array(string(o_totalprice), string(o_totalprice), "
        "if(o_orderkey % 5 = 0, 'n/a', string(o_custkey / 2)))",
    )
    return quality.image_qc(rows).select("subject", "session", "qc_mean_fd", "qc_max_fd", "qc_ndc")


def _group_table(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as _row_order", key,
        "concat(if(o_orderkey % 2 = 0, 'ses-', ''), year(o_orderdate)) as session_id",
        "'dwi' as task_id", "if(o_orderkey % 9 = 0, 'n/a', string(o_totalprice)) as price",
        "o_orderpriority as site",
    )


def _group_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('sub-', o_custkey) as subject",
        "if(o_custkey % 5 = 0, '_no_session', "
        "concat('ses-', year(o_orderdate) + int(o_orderkey % 3 = 0))) as session",
    ).distinct()


_GROUP_SQL = """
    WITH spine AS (
      SELECT DISTINCT 'sub-' || o_custkey AS subject, o_custkey AS c,
             CASE WHEN o_custkey % 5 = 0 THEN '_no_session'
                  ELSE 'ses-' || (year(o_orderdate) + CAST(o_orderkey % 3 = 0 AS INTEGER)) END AS session
      FROM orders),
    hits AS (
      SELECT s.subject, s.session, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS mriqc_price,
             o_orderpriority AS mriqc_site,
             row_number() OVER (PARTITION BY s.subject, s.session ORDER BY o_orderkey) AS rank
      FROM spine s JOIN orders ON o_custkey = s.c
        AND (s.session = '_no_session' OR s.session = 'ses-' || year(o_orderdate)))
    SELECT subject, session, mriqc_price, mriqc_site FROM hits WHERE rank = 1"""


@query(_GROUP_SQL)
def iqm_lookup(spark, sf_dir):
    """First row of the group metrics for each session, by subject and session id."""
    group = _group_table(
        spark, sf_dir, "concat(if(o_orderkey % 4 < 2, 'sub-', ''), o_custkey) as subject_id"
    )
    return quality.group_lookup(_group_spine(spark, sf_dir), group)


@query(_GROUP_SQL)
def iqm_bids_name(spark, sf_dir):
    """The same when the table names its scans instead of its subjects."""
    group = _group_table(
        spark, sf_dir, "concat('sub-', o_custkey, if(o_orderkey % 2 = 0, '_dwi', '')) as bids_name"
    )
    return quality.group_lookup(_group_spine(spark, sf_dir), group)


@query("""
    WITH m AS (
      SELECT 'sub-' || user_id AS subject, 'ses-' || event_type AS session, count(*) AS qc_n_volumes
      FROM events WHERE user_id % 3 = 0 OR user_id % 2 = 1 GROUP BY ALL),
    i AS (
      SELECT 'sub-' || user_id AS subject, 'ses-' || event_type AS session, min(value) AS qc_mean_fd
      FROM events WHERE user_id % 2 = 0 GROUP BY ALL),
    g AS (
      SELECT 'sub-' || user_id AS subject, 'ses-' || event_type AS session, max(value) AS mriqc_efc
      FROM events WHERE user_id % 5 = 0 GROUP BY ALL)
    SELECT subject, session, qc_mean_fd, qc_n_volumes, mriqc_efc
    FROM i FULL JOIN m USING (subject, session) FULL JOIN g USING (subject, session)""")
def qc_merge(spark, sf_dir):
    """Three sources of quality data in one row per session that has any."""
    def part(users: str, value: str) -> DataFrame:
        return (
            table(spark, sf_dir, "events").where(users)
            .selectExpr("concat('sub-', user_id) as subject", "concat('ses-', event_type) as session", "value")
            .groupBy("subject", "session").agg(F.expr(value))
        )

    return quality.merge_qc(
        part("user_id % 2 = 0", "min(value) as qc_mean_fd"),
        part("user_id % 3 = 0 or user_id % 2 = 1", "count(value) as qc_n_volumes"),
        part("user_id % 5 = 0", "max(value) as mriqc_efc"),
    )


# Ages, versions, flags ---------------------------------------------------------


def _ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.session_ages(inputs.order_rows(
        spark, sf_dir,
        "case o_custkey % 3 when 0 then array('session_id', 'age_months') "
        "when 1 then array('ses', 'age') else array('age_in_months', 'session') end",
        """transform(
             if(o_custkey % 3 = 2, array(1, 0), array(0, 1)),
             k -> if(k = 0, concat(if(o_orderkey % 2 = 0, 'ses-', ' '), year(o_orderdate)),
                     case when o_orderkey % 13 = 0 then 'n/a' when o_orderkey % 7 = 0 then 'two'
                          else string(floor(o_totalprice / 1000)) end))""",
    ))


_AGES_SQL = """
    ages AS (
      SELECT subject, session,
             CASE WHEN i % 13 <> 0 THEN CAST(a AS DOUBLE) END AS session_age_months
      FROM (SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session,
                   o_orderkey AS i, floor(o_totalprice / 1000) AS a,
                   row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                      ORDER BY o_orderkey DESC) AS rank
            FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 13 = 0)
      WHERE rank = 1)"""


@query(f"""
    WITH {_AGES_SQL}
    SELECT o_orderkey, a.session_age_months FROM orders
    LEFT JOIN ages a ON a.subject = 'sub-' || o_custkey AND a.session = 'ses-' || year(o_orderdate)""")
def session_age(spark, sf_dir):
    """Age at each session: column aliases, label prefixes, last row wins."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat('sub-', o_custkey) as subject",
        "concat('ses-', year(o_orderdate)) as session",
    )
    return col.broadcast_sessions(orders, _ages(spark, sf_dir)).drop("subject", "session")


def _descriptions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    suppliers = table(spark, sf_dir, "supplier")
    preproc = suppliers.selectExpr(
        "concat('/data/', lpad(s_suppkey, 12, '0'), '/dataset_description.json') as path",
        """concat('{"GeneratedBy": [{"Name": "x", "Version": ""}], "Version": "p',
                  s_acctbal, '"}') as content""",
    )
    recon = suppliers.selectExpr(
        "concat('/data/qsirecon-S', lpad(s_suppkey, 12, '0'), '/dataset_description.json') as path",
        """case s_suppkey % 4 when 0 then '{"Name": "x"}' when 1 then '{bad'
             when 2 then concat('{"Version": "v', s_acctbal, '"}')
             else concat('{"GeneratedBy": [{"Version": "g', s_acctbal, '"}], "Version": "0"}') end
           as content""",
    )
    return preproc, recon


_VERSIONS_SQL = """
    versions AS (
      SELECT 'p' || arg_min(s_acctbal, s_suppkey) AS qsiprep_version,
             arg_min(CASE s_suppkey % 4 WHEN 2 THEN 'v' ELSE 'g' END || s_acctbal, s_suppkey)
               FILTER (WHERE s_suppkey % 4 >= 2) AS qsirecon_version
      FROM supplier)"""


@query(f"WITH {_VERSIONS_SQL} SELECT c_custkey, versions.* FROM customer, versions")
def version_pick(spark, sf_dir):
    """First known version of the datasets as constant columns."""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return meta.add_versions(customers, *_descriptions(spark, sf_dir))


_FLAG_CASE = """
    CASE WHEN d IS NULL THEN 'UNKNOWN:sidecar_missing'
         WHEN abs(d - 1.7) < 1e-6 AND coalesce(age <= 18, false) THEN 'WARN:adult_default_d_par_in_infant'
         WHEN abs(d - 1.7) < 1e-6 THEN 'INFO:adult_default_d_par'
         WHEN abs(d - {expected}) < 1e-6 THEN 'OK:custom_d_par_matches_expected'
         ELSE printf('WARN:unexpected_d_par:%.4f', d) END"""
_FLAGS_SQL = f"""
    flags AS (
      SELECT p_partkey, {_FLAG_CASE.format(expected=1.5)} AS noddi_d_par_flag
      FROM (SELECT p_partkey,
                   CASE p_partkey % 5 WHEN 0 THEN 1.7::DOUBLE WHEN 1 THEN 1.5::DOUBLE WHEN 2 THEN NULL
                        ELSE p_retailprice / 1000 END AS d,
                   CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS age
            FROM part))"""


def _flagged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "case p_partkey % 5 when 0 then 1.7D when 1 then 1.5D when 2 then null "
        "else p_retailprice / 1000 end as noddi_d_par",
        "if(p_partkey % 7 = 0, null, double(p_size)) as session_age_months",
    )
    return col.add_flag(parts, 18.0, 1.5).select("p_partkey", "noddi_d_par_flag")


@query(f"WITH {_FLAGS_SQL} SELECT * FROM flags")
def assumption_flag(spark, sf_dir):
    """Audit flag of an assumed parameter, by value and age."""
    return _flagged_parts(spark, sf_dir)


@query(f"WITH {_FLAGS_SQL} SELECT noddi_d_par_flag, count(*) AS n_rows FROM flags GROUP BY ALL")
def flag_counts(spark, sf_dir):
    """Rows per flag."""
    return col.flag_counts(_flagged_parts(spark, sf_dir))


@query("SELECT p_partkey, 'UNKNOWN:no_noddi_data' AS noddi_d_par_flag FROM part")
def flag_without_model(spark, sf_dir):
    """The flag when no sidecar gave the parameter at all."""
    return col.add_flag(table(spark, sf_dir, "part").select("p_partkey"))


# Data quality -----------------------------------------------------------------


@query("""
    WITH o AS (
      SELECT 'sub-' || o_custkey AS subject, 'ses-' || year(o_orderdate) AS session, o_orderkey AS i,
             substr(o_orderpriority, 1, 1) AS kind,
             CASE WHEN o_orderkey % 6 <> 0 THEN '/f/' || o_orderkey END AS path
      FROM orders),
    files AS (
      SELECT subject, session,
             last(path ORDER BY i) FILTER (WHERE kind = '1') AS b,
             last(path ORDER BY i) FILTER (WHERE kind = '2') AS q,
             last(path ORDER BY i) FILTER (WHERE kind = '3') AS c,
             last(path ORDER BY i) FILTER (WHERE kind = '4') AS n
      FROM o WHERE kind <> '5' GROUP BY ALL),
    warns AS (
      SELECT subject, session,
             string_agg('w' || i, '|' ORDER BY i % 3, lpad(CAST(i AS VARCHAR), 12, '0')) AS w
      FROM o WHERE kind = '5' GROUP BY ALL)
    SELECT subject, session,
           CASE WHEN b IS NOT NULL AND q IS NOT NULL AND w IS NULL THEN 'ok'
                WHEN b IS NOT NULL OR q IS NOT NULL THEN 'partial' ELSE 'missing' END AS status,
           coalesce(b, '') AS bundle_scalar_file, coalesce(q, '') AS qc_file,
           coalesce(c, '') AS confounds_file, n IS NOT NULL AS noddi_json_found,
           coalesce(w, '') AS warnings
    FROM files FULL JOIN warns USING (subject, session)""")
def run_log(spark, sf_dir):
    """Last file per type, all warnings in order, status per session."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
        "o_orderkey", "left(o_orderpriority, 1) as kind",
        "if(o_orderkey % 6 = 0, null, concat('/f/', o_orderkey)) as path",
    )
    kind = F.expr("element_at(array('bundle_scalar', 'qc', 'confounds', 'noddi_json'), int(kind))")
    files = log.file_events(orders.where("kind <> '5'"), kind, order="o_orderkey")
    warned = orders.where("kind = '5'").selectExpr(
        "subject", "session", "o_orderkey % 3 as step", "lpad(o_orderkey, 12, '0') as path",
        "concat('w', o_orderkey) as message",
    )
    return log.run_log(files, warned)


@query("""
    SELECT event_type AS column_name, 'Auto-documented column: ' || event_type AS description,
           '' AS units, '' AS model, '' AS source_file_pattern,
           'Auto-generated entry. dtype=double' AS notes
    FROM (SELECT DISTINCT event_type FROM events)
    UNION ALL SELECT * FROM (VALUES
      ('subject', 'Label of the subject folder', '', '', 'BIDS directory structure', ''),
      ('session', 'Label of the session folder', '', '', 'BIDS directory structure',
       '_no_session where the subject has no session folders'),
      ('bundle', 'White-matter bundle, in lower case with underscores', '', '', '',
       'The set of bundles depends on the workflow, e.g. 72 for TractSeg'),
      ('qc_extra', 'QSIPrep QC metric: extra', '', '',
       '*_desc-image_qc.tsv or *_desc-confounds_timeseries.tsv', 'Auto-generated entry. dtype=bigint'))""")
def data_dictionary_rows(spark, sf_dir):
    """Dictionary of a wide table whose columns come from the data."""
    records = table(spark, sf_dir, "events").selectExpr(
        "concat('sub-', user_id) as subject", "concat('ses-', int(month(ts))) as session",
        "'all' as bundle", "event_type as scalar", "value", "event_id", "event_id as qc_extra",
    )
    return data_dictionary(col.wide_table(records, order=["event_id"], keep=["qc_extra"]))


# All together -----------------------------------------------------------------

def _session_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    motion = inputs.motion_lines(spark, sf_dir).withColumn(
        "session", F.expr("concat('ses-', 1995 + (row - 1) % 7)")
    )
    # One header line per time series of the supplier cohort.
    spine = col.session_grid(*inputs.cohort_axes(spark, sf_dir))
    lines = spine.selectExpr(
        "concat(subject, session, '.tsv') as path", "subject", "session", "0L as row",
        r"'trans_x\tframewise_displacement\tCSF' as line",
    ).unionByName(motion.where("row > 0").withColumn("path", F.expr("concat(subject, session, '.tsv')")))
    qc = quality.censoring_summary(line_rows(lines, "raw"), 40.0)
    sidecars = side.reduce_sidecars(side.sidecar_fields(inputs.sidecar_documents(spark, sf_dir)))
    info = col.session_metadata(spine, sidecars, qc, _ages(spark, sf_dir), 100.0, 50.0)
    return meta.add_versions(info, *_descriptions(spark, sf_dir))


_COLLATED_SQL = f"""{_GRID_SQL}, {SIDECARS_SQL}, {_AGES_SQL}, {_VERSIONS_SQL},
    motion AS (
      SELECT 'sub-' || user_id AS subject, 'ses-' || (1995 + event_id % 7) AS session,
             count(*) AS qc_n_volumes,
             count(*) FILTER (WHERE value > 40 AND event_id % 11 <> 0) AS qc_n_censored
      FROM events WHERE 'sub-' || user_id IN (SELECT DISTINCT 'sub-' || l_suppkey FROM lineitem)
        AND (1995 + event_id % 7) IN (SELECT DISTINCT year(l_shipdate) FROM lineitem) GROUP BY ALL),
    info AS (
      SELECT g.subject, g.session, noddi_d_par, noddi_d_iso, noddi_sidecar_count, dti_fitting_method,
             dti_sidecar_count, coalesce(noddi_modulated_present, false) AS noddi_modulated_present,
             qc_n_volumes, qc_n_censored, round(qc_n_censored / qc_n_volumes, 6) AS qc_pct_censored,
             CASE WHEN qc_n_volumes IS NOT NULL THEN 40.0::DOUBLE END AS qc_fd_threshold_used,
             session_age_months,
             CASE WHEN noddi_d_par IS NULL THEN 'UNKNOWN:sidecar_missing'
                  WHEN abs(noddi_d_par - 50) < 1e-6 THEN 'OK:custom_d_par_matches_expected'
                  ELSE printf('WARN:unexpected_d_par:%.4f', noddi_d_par) END AS noddi_d_par_flag
      FROM (SELECT DISTINCT subject, session FROM grid) g
      LEFT JOIN sidecars USING (subject, session) LEFT JOIN motion USING (subject, session)
      LEFT JOIN ages USING (subject, session))"""


@query(f"""{_COLLATED_SQL}
    SELECT l.*, info.* EXCLUDE (subject, session), versions.*, CAST(NULL AS BIGINT) AS n_nodes
    FROM long l JOIN info USING (subject, session), versions""")
def collated_long(spark, sf_dir):
    """The whole long table: grid, sidecars, quality, ages, flags, versions."""
    return col.collate(
        _bundle_records(spark, sf_dir, withhold=True), *inputs.cohort_axes(spark, sf_dir),
        _session_info(spark, sf_dir),
    )


@query(f"""{_COLLATED_SQL},
    wide AS (
      SELECT subject, session, bundle,
             max(value) FILTER (WHERE scalar = 'fa_mean') AS fa_mean,
             max(value) FILTER (WHERE scalar = 'fa_std') AS fa_std,
             max(value) FILTER (WHERE scalar = 'length_mean') AS length_mean,
             max(value) FILTER (WHERE scalar = 'qa_mean') AS qa_mean,
             max(value) FILTER (WHERE scalar = 'volume') AS volume,
             max(recon_suffix) AS recon_suffix, max(bundle_source) AS bundle_source
      FROM long GROUP BY ALL)
    SELECT w.*, info.* EXCLUDE (subject, session), versions.*, CAST(NULL AS BIGINT) AS n_nodes
    FROM wide w JOIN info USING (subject, session), versions""")
def collated_wide(spark, sf_dir):
    """The whole wide table, a row for every subject x session x bundle."""
    return col.collate(
        _bundle_records(spark, sf_dir, withhold=True), *inputs.cohort_axes(spark, sf_dir),
        _session_info(spark, sf_dir), "wide",
    )


# File trees -------------------------------------------------------------------

_TREE_SQL = f"""
    WITH {BUNDLE_RECORDS_SQL},
    visits AS (
      SELECT l_suppkey AS s, year(l_shipdate) AS y, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS volume,
             count(*) FILTER (WHERE round(l_tax * 10, 2) > 0.5 AND (l_orderkey * 8 + l_linenumber) % 11 <> 0) AS c
      FROM lineitem GROUP BY ALL),
    kept AS (SELECT * EXCLUDE (s, y) FROM records WHERE (s + y) % 10 > 1),
    spine AS (SELECT 'sub-' || s AS subject, 'ses-' || y AS session, s, y
              FROM (SELECT DISTINCT s FROM visits), (SELECT DISTINCT y FROM visits)),
    model AS (
      SELECT s, y, CASE WHEN s % 10 <> 4 THEN CASE WHEN y % 2 = 0 THEN 1.7::DOUBLE ELSE 1.1::DOUBLE END END AS d_par
      FROM visits WHERE s % 2 = 0),
    told AS (
      SELECT subject, session, d_par AS noddi_d_par, CAST(NULL AS DOUBLE) AS noddi_d_iso, false AS noddi_modulated_present,
             CASE WHEN m.s IS NOT NULL THEN 1 END::BIGINT AS noddi_sidecar_count, CAST(NULL AS VARCHAR) AS dti_fitting_method,
             CAST(NULL AS BIGINT) AS dti_sidecar_count, CASE WHEN v.s IS NOT NULL THEN (y - 1990)::DOUBLE END AS session_age_months,
             CASE WHEN d_par IS NULL THEN 'UNKNOWN:sidecar_missing' WHEN d_par <> 1.7 THEN 'WARN:unexpected_d_par:1.1000'
                  ELSE 'WARN:adult_default_d_par_in_infant' END AS noddi_d_par_flag,
             '1.2' AS qsiprep_version, '1.2' AS qsirecon_version, v.s, v.y, v.n, v.c, v.volume
      FROM spine LEFT JOIN visits v USING (s, y) LEFT JOIN model m USING (s, y)),
    qc AS (
      SELECT * EXCLUDE (s, y, n, c, volume),
             {", ".join(f"CAST(NULL AS DOUBLE) AS qc_{c}" for c in (
                 "mean_fd", "max_fd", "ndc", "num_bad_slices", "ndc_raw", "num_bad_slices_raw", "max_translation", "max_rotation",
                 "max_rel_translation", "max_rel_rotation", "t1_dice_distance", "mni_dice_distance"))},
             CASE WHEN s % 10 <> 3 THEN n END AS qc_n_volumes, CASE WHEN s % 10 <> 3 THEN c END AS qc_n_censored,
             CASE WHEN s % 10 <> 3 THEN round(c / n, 6) END AS qc_pct_censored, CASE WHEN s % 10 <> 3 THEN 0.5::DOUBLE END AS qc_fd_threshold_used,
             volume::DOUBLE AS mriqc_volume, CASE s % 2 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS mriqc_site
      FROM told),
    files AS (
      SELECT s, y, 'sub-' || s AS subject, 'ses-' || y AS session,
             'sub-' || s || '_ses-' || y || CASE WHEN s % 2 = 1 THEN '_bundle_means.tsv' ELSE '_bundles-A_scalarstats.csv' END AS bundle_name,
             '/recon/derivatives/qsirecon-W' || (s % 3) || '/sub-' || s || '/ses-' || y || '/dwi/' AS bundle_folder,
             '/preproc/sub-' || s || '/ses-' || y || '/dwi/x' || CASE WHEN y % 2 = 0 THEN '_desc-confounds_timeseries.tsv' ELSE '_confounds.tsv' END AS motion,
             '/recon/derivatives/qsirecon-MODEL/sub-' || s || '/ses-' || y || '/dwi/m_model-noddi_param-od_dwimap.json' AS sidecar
      FROM visits)"""


def _built(spark: SparkSession, sf_dir: str, **parameters) -> tuple[job.Outputs, str]:
    """Outputs of the whole job on a tree of files, which is gone by then: all that is read is staged."""
    folder = trees.write_tree(spark, sf_dir)
    outputs = job.build(spark, f"{folder}/preproc", f"{folder}/recon", f"{folder}/group", **parameters)
    remove_dir(spark, folder)
    return outputs, folder


def _below(path: str, folder: str):
    """Paths as they stand below the study folder, wherever in a text."""
    return F.regexp_replace(path, rf"[A-Za-z]+:[^ |]*/{folder.rpartition('/')[2]}", "")


@query(f"""{_TREE_SQL}
    SELECT bundle_folder || bundle_name AS path, (s + y) % 10 = 0 AS is_empty FROM files
    UNION ALL SELECT motion, s % 10 = 3 FROM files
    UNION ALL SELECT sidecar, s % 10 = 4 FROM files WHERE s % 2 = 0
    UNION ALL SELECT DISTINCT '/preproc/' || subject || '/sessions.tsv', false FROM files
    UNION ALL VALUES ('/preproc/dataset_description.json', false), ('/recon/derivatives/qsirecon-W0/dataset_description.json', false)""")
def tree_inventory(spark, sf_dir):
    """Both trees listed, files without a byte included."""
    folder = trees.write_tree(spark, sf_dir)
    globs = [*src.preproc_globs(f"{folder}/preproc"), *src.recon_globs(spark, f"{folder}/recon")]
    listed = stage(src.list_files(spark, globs), "tree")
    remove_dir(spark, folder)
    return listed.select(_below("path", folder).alias("path"), (F.col("file_size") == 0).alias("is_empty"))


@query(f"""{_TREE_SQL}
    SELECT subject AS subject_id, session AS session_id, CAST(volume AS VARCHAR) AS volume,
           CASE s % 2 WHEN 0 THEN 'a' ELSE 'b' END AS site FROM files JOIN visits USING (s, y)""")
def tree_group_table(spark, sf_dir):
    """The group-level table read from its file, ids and metrics as text."""
    folder = trees.write_tree(spark, sf_dir, subjects=False)
    found = stage(src.read_group_table(spark, f"{folder}/group"), "group")
    remove_dir(spark, folder)
    return found.drop(src.ROW_ORDER)


@query(f"""{_TREE_SQL}
    SELECT g.*, k.* EXCLUDE (subject, session, bundle, scalar), k.subject IS NOT NULL AS scalar_present,
           qc.* EXCLUDE (subject, session), CAST(NULL AS BIGINT) AS n_nodes
    FROM (SELECT subject, session, bundle, scalar FROM spine, (SELECT DISTINCT bundle FROM kept), (SELECT DISTINCT scalar FROM kept)) g
    LEFT JOIN kept k USING (subject, session, bundle, scalar) JOIN qc USING (subject, session)""")
def tree_long(spark, sf_dir):
    """The whole job from files to the long table; empty and wrongly encoded files give gaps."""
    return _built(spark, sf_dir)[0].table


@query(f"""{_TREE_SQL}
    SELECT g.*, w.* EXCLUDE (subject, session, bundle), CAST(NULL AS BIGINT) AS n_nodes,
           told.* EXCLUDE (subject, session, s, y, n, c, volume)
    FROM (SELECT subject, session, bundle FROM spine, (SELECT DISTINCT bundle FROM kept)) g
    LEFT JOIN (
      SELECT subject, session, bundle, max(value) FILTER (WHERE scalar = 'fa_mean') AS fa_mean,
             max(value) FILTER (WHERE scalar = 'fa_std') AS fa_std, max(value) FILTER (WHERE scalar = 'length_mean') AS length_mean,
             max(value) FILTER (WHERE scalar = 'qa_mean') AS qa_mean, max(value) FILTER (WHERE scalar = 'volume') AS volume,
             max(recon_suffix) AS recon_suffix, max(bundle_source) AS bundle_source
      FROM kept GROUP BY ALL) w USING (subject, session, bundle) JOIN told USING (subject, session)""")
def tree_wide(spark, sf_dir):
    """The whole job without its optional stages, as a wide table."""
    outputs = _built(spark, sf_dir, scalar_format="wide", include_qc=False, include_data_dictionary=False)[0]
    return outputs.table


@query(f"""{_TREE_SQL},
    events AS (
      SELECT subject, session, 1 AS step, 'parse_error:' || bundle_name || ':Could not read ' || bundle_folder || bundle_name || ': ' ||
             CASE (s + y) % 10 WHEN 0 THEN 'No columns to parse from file' ELSE 'the file is no UTF-8 text' END AS message
      FROM files WHERE (s + y) % 10 < 2
      UNION ALL SELECT subject, session, 2, 'dwimap_json_error:Could not read ' || sidecar FROM files WHERE s % 10 = 4
      UNION ALL SELECT subject, session, 3, 'confounds_error:Could not read ' || motion || ': No columns to parse from file' FROM files WHERE s % 10 = 3
      UNION ALL SELECT subject, session, 4, 'no_scalar_data' FROM spine ANTI JOIN kept USING (subject, session)),
    texts AS (SELECT subject, session, string_agg(message, '|' ORDER BY step, message) AS warnings FROM events GROUP BY ALL),
    used AS (
      SELECT subject, session, CASE WHEN (s + y) % 10 > 1 THEN bundle_folder || bundle_name ELSE '' END AS bundle_scalar_file,
             motion AS confounds_file, s % 2 = 0 AS noddi_json_found FROM files)
    SELECT coalesce(u.subject, t.subject) AS subject, coalesce(u.session, t.session) AS session,
           CASE WHEN coalesce(bundle_scalar_file, '') <> '' THEN 'partial' ELSE 'missing' END AS status,
           coalesce(bundle_scalar_file, '') AS bundle_scalar_file, '' AS qc_file, coalesce(confounds_file, '') AS confounds_file,
           coalesce(noddi_json_found, false) AS noddi_json_found, coalesce(warnings, '') AS warnings
    FROM used u FULL JOIN texts t USING (subject, session)""")
def tree_run_log(spark, sf_dir):
    """The run log of a job on files, each that cannot be used with its reason."""
    outputs, folder = _built(spark, sf_dir)
    paths = ("bundle_scalar_file", "qc_file", "confounds_file", "warnings")
    return outputs.run_log.withColumns({c: _below(c, folder) for c in paths})
