"""Derivative-like inputs made by Spark from the benchmark tables.

Role mapping: subject = supplier, customer or user; session = year or event type;
bundle = return flag. Text files are built from whole tables and parsed back.
Values are aggregated first, so a document never holds more than one line per
return flag; unbounded tables are given line by line instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECON = "/data/recon/derivatives/qsirecon-W"
ENTITY_COLUMNS = ("path", "subject", "session", "recon_suffix")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bundle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s, y, f, q, d, t``: totals per supplier, year and return flag."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_suppkey as s", "year(l_shipdate) as y", "l_returnflag as f",
                    "l_quantity", "l_discount", "l_tax")
        .groupBy("s", "y", "f")
        .agg({"l_quantity": "sum", "l_discount": "sum", "l_tax": "sum"})
        .selectExpr("s", "y", "f", "`sum(l_quantity)` as q",
                    "round(`sum(l_discount)`, 2) as d", "round(`sum(l_tax)`, 2) as t")
    )


def bundle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bundle table per supplier and year: tab-separated for odd suppliers,
    quoted CSV with other columns in another order for even ones."""
    return (
        bundle_totals(spark, sf_dir)
        .selectExpr(
            "s", "y",
            r"""if(s % 2 = 1,
                   concat_ws('\t', concat(' ', f, '-x'), q, d, t),
                   concat_ws(',', q, concat('"Tract ', f, ', x"'), d,
                             if(s % 7 = 0, 'n/a', string(t)))) as line""",
        )
        .groupBy("s", "y")
        .agg({"line": "collect_list"})
        .selectExpr(
            f"""concat('{RECON}', s % 3, '/sub-', s, '/ses-', y, '/dwi/sub-', s, '_ses-', y,
                       if(s % 2 = 1, '_bundle_means.tsv', '_bundles-A_scalarstats.csv')) as path""",
            "concat('sub-', s) as subject", "concat('ses-', y) as session",
            "concat('W', s % 3) as recon_suffix",
            "if(s % 2 = 1, 'bundle_means', 'scalarstats') as source_type",
            "s", "y",
            r"""concat(if(s % 2 = 1, 'Bundle Name\tmean_FA\tstd_fa\tvolume\r\n',
                          'dti_fa,tractname,mean_length,qa\r\n'),
                       array_join(array_sort(`collect_list(line)`), '\r\n')) as content""",
        )
    )


BUNDLE_RECORDS_SQL = """
    totals AS (
      SELECT l_suppkey AS s, year(l_shipdate) AS y, l_returnflag AS f, sum(l_quantity) AS q,
             round(sum(l_discount), 2) AS d, round(sum(l_tax), 2) AS t
      FROM lineitem GROUP BY ALL),
    cells AS (
      SELECT s, y, lower(f) || '_x' AS bundle, 'mean_fa' AS scalar_raw, 'fa_mean' AS scalar,
             q AS value FROM totals WHERE s % 2 = 1
      UNION ALL SELECT s, y, lower(f) || '_x', 'std_fa', 'fa_std', d FROM totals WHERE s % 2 = 1
      UNION ALL SELECT s, y, lower(f) || '_x', 'volume', 'volume', t FROM totals WHERE s % 2 = 1
      UNION ALL SELECT s, y, 'tract_' || lower(f) || ',_x', 'dti_fa', 'fa_mean', q
                FROM totals WHERE s % 2 = 0
      UNION ALL SELECT s, y, 'tract_' || lower(f) || ',_x', 'mean_length', 'length_mean', d
                FROM totals WHERE s % 2 = 0
      UNION ALL SELECT s, y, 'tract_' || lower(f) || ',_x', 'qa', 'qa_mean', t
                FROM totals WHERE s % 2 = 0 AND s % 7 <> 0),
    records AS (
      SELECT 'sub-' || s AS subject, 'ses-' || y AS session, bundle, scalar, scalar_raw, value,
             CASE WHEN s % 2 = 1 THEN 'bundle_means' ELSE 'scalarstats' END AS bundle_source,
             'W' || (s % 3) AS recon_suffix,
             scalar_raw IN ('volume', 'mean_length') AS is_shape_stat, s, y
      FROM cells)"""


def cohort_axes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All subjects and all sessions of the supplier cohort."""
    items = table(spark, sf_dir, "lineitem")
    return (
        items.selectExpr("concat('sub-', l_suppkey) as subject").distinct(),
        items.selectExpr("concat('ses-', year(l_shipdate)) as session").distinct(),
    )


def tract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node-by-bundle tables, one per supplier and year, as lines."""
    items = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_suppkey": "s"})
    entities = (
        f"""concat('{RECON}', s % 3, '/sub-', s, '/ses-', y, '/dwi/sub-', s, '_tractometry_FA.csv')
            as path""",
        "concat('sub-', s) as subject", "concat('ses-', y) as session",
        "concat('W', s % 3) as recon_suffix",
    )
    heads = items.selectExpr("s", "year(l_shipdate) as y").distinct().selectExpr(
        *entities, "0L as row", "',AF_left,CST-right,ifo r,0.5' as line"
    )
    return heads.unionByName(
        items.withColumn("y", F.year("l_shipdate")).selectExpr(
            *entities, "l_orderkey + 1 as row",
            """concat_ws(',', l_orderkey, l_quantity, round(l_discount * 100),
                         if(l_linenumber = 3, 'n/a', string(round(l_tax * 100))), 1) as line""",
        )
    )


def stats_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-bundle statistics, one table per supplier and year."""
    return (
        bundle_totals(spark, sf_dir)
        .selectExpr("s", "y", "concat_ws(',', if(f = 'A', 'n/a', f), q, "
                              "case y % 3 when 0 then 'n/a' when 1 then 'bad' else string(d) end) as line")
        .groupBy("s", "y")
        .agg({"line": "collect_list"})
        .selectExpr(
            f"concat('{RECON}', s % 3, '/sub-', s, '/ses-', y, '/dwi/sub-', s, '_tractometry-md.csv') as path",
            "concat('sub-', s) as subject", "concat('ses-', y) as session",
            "concat('W', s % 3) as recon_suffix",
            "concat('bundle,mean,std\n', array_join(array_sort(`collect_list(line)`), '\n')) as content",
        )
    )


def motion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Displacement time series, one per user and event type, as lines."""
    events = table(spark, sf_dir, "events")
    keys = (
        """concat('/data/preproc/sub-', user_id, '/ses-', event_type,
                  '/dwi/x_desc-confounds_timeseries.tsv') as path""",
        "concat('sub-', user_id) as subject", "concat('ses-', event_type) as session",
    )
    heads = events.select("user_id", "event_type").distinct().selectExpr(
        *keys, "0L as row", r"'trans_x\tframewise_displacement\tCSF' as line",
    )
    return heads.unionByName(
        events.selectExpr(
            *keys, "event_id + 1 as row",
            r"concat_ws('\t', event_id % 10, if(event_id % 11 = 0, 'n/a', string(value)), 0) as line",
        )
    )


def order_rows(spark: SparkSession, sf_dir: str, header: str, values: str) -> DataFrame:
    """Row frame with one row per order; a customer is the subject, a year the session."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('sub-', o_custkey) as subject", "concat('ses-', year(o_orderdate)) as session",
        "concat('/data/preproc/sub-', o_custkey, '.tsv') as path",
        "o_orderkey as row", f"{header} as header", f"{values} as values",
        "string(null) as problem",
    )


# The root of the inventories: a folder above it is named like that of a subject.
RECON_ROOT = "/data/sub-study/recon"


def order_files(spark: SparkSession, sf_dir: str, names: str) -> DataFrame:
    """Inventory with one file per order. Every third customer has no session
    folders; of the others, some orders lie outside of one. Some files lie deeper,
    in a folder that is named like that of a subject."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"""concat('{RECON_ROOT}/', if(o_orderkey % 4 < 2, 'derivatives/', ''), 'qsirecon-',
                   o_orderstatus, '/sub-', o_custkey, '/',
                   if(o_custkey % 3 = 0 or o_orderkey % 10 = 0, '',
                      concat('ses-', year(o_orderdate), '/')),
                   case o_orderkey % 12 when 5 then 'anat' when 7 then 'dwi/sub-1_work' else 'dwi' end,
                   '/', {names}) as path"""
    )


def sidecar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON sidecar per event; keys and validity vary."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('sub-', user_id) as subject", "concat('ses-', 1995 + event_id % 7) as session",
        """concat('/data/recon/sub-', user_id, '/', lpad(event_id, 12, '0'),
                  case event_id % 5 when 0 then '_model-noddi_desc-modulated_param-icvf'
                       when 1 then '_model-tensor_param-fa' else '_model-noddi_param-od' end,
                  '_dwimap.json') as path""",
        """case when event_id % 13 = 0 then '{bad'
                when event_id % 5 = 1 then replace(props, '"k"', '"Method"')
                when event_id % 3 = 0 then replace(props, '"k"', '"dPar"')
                when event_id % 3 = 1 then replace(props, '"k"', '"d_par": null, "dpar"')
                else replace(props, '"k"', '"IsotropicDiffusivity"') end as content""",
    )


SIDECARS_SQL = """
    files AS (
      SELECT 'sub-' || user_id AS subject, 'ses-' || (1995 + event_id % 7) AS session, event_id AS i,
             event_id % 5 <> 1 AS noddi, event_id % 5 = 0 AS modulated, event_id % 13 <> 0 AS readable,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
      FROM events),
    sidecars AS (
      SELECT subject, session,
             arg_min(k, i) FILTER (WHERE noddi AND readable AND i % 3 <> 2) AS noddi_d_par,
             arg_min(k, i) FILTER (WHERE noddi AND readable AND i % 3 = 2) AS noddi_d_iso,
             CASE WHEN count(*) FILTER (WHERE noddi) > 0
                  THEN coalesce(bool_or(noddi AND modulated AND readable), false) END
               AS noddi_modulated_present,
             nullif(count(*) FILTER (WHERE noddi), 0) AS noddi_sidecar_count,
             CAST(CAST(arg_min(k, i) FILTER (WHERE NOT noddi AND readable) AS BIGINT) AS VARCHAR)
               AS dti_fitting_method,
             nullif(count(*) FILTER (WHERE NOT noddi), 0) AS dti_sidecar_count
      FROM files GROUP BY ALL)"""
