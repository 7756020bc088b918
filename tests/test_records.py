import numpy as np
import pandas as pd
import pytest

from scalargrid.operators import records as rec
from scalargrid.sources.tables import table_rows

FOLDER = "/d/qsirecon-NODDI/sub-01/ses-1mo/dwi/"


def rows(spark, name, content):
    schema = "path string, subject string, session string, recon_suffix string, content string"
    return table_rows(
        spark.createDataFrame([(FOLDER + name, "sub-01", "ses-1mo", "NODDI", content)], schema)
    )


def as_dict(df):
    return {(r["bundle"], r["scalar"]): r["value"] for r in df.collect()}


def test_bundle_means(spark):
    text = "bundle_name\tmean_fa\tstd_fa\tmean_icvf\nAF_left\t0.38\t0.04\t0.42\nCST left\t0.51\t0.05\t0.55\n"
    df = rec.bundle_table_records(rows(spark, "x_bundle_means.tsv", text))
    assert as_dict(df) == {
        ("af_left", "fa_mean"): 0.38, ("af_left", "fa_std"): 0.04, ("af_left", "icvf_mean"): 0.42,
        ("cst_left", "fa_mean"): 0.51, ("cst_left", "fa_std"): 0.05, ("cst_left", "icvf_mean"): 0.55,
    }
    first = df.first()
    assert (first["subject"], first["session"], first["recon_suffix"], first["bundle_source"]) == (
        "sub-01", "ses-1mo", "NODDI", "bundle_means")
    assert df.columns == list(rec.RECORD_COLUMNS)


def test_scalarstats(spark):
    df = rec.bundle_table_records(rows(
        spark, "x_bundles-A_scalarstats.csv",
        "tractname,dti_fa,gfa,mean_length\nAF_left,0.38,0.55,85.2\nCST_left,0.51,0.60,120.0\n"))
    assert as_dict(df)[("af_left", "fa_mean")] == 0.38
    shapes = {r["scalar_raw"]: r["is_shape_stat"] for r in df.collect()}
    assert shapes == {"dti_fa": False, "gfa": False, "mean_length": True}
    assert {r["bundle_source"] for r in df.collect()} == {"scalarstats"}


def test_missing_cells_and_bundles(spark):
    df = rec.bundle_table_records(rows(
        spark, "x_bundle_means.tsv",
        "bundle_name\tmean_fa\tmean_md\nAF\tn/a\t0.0007\nnan\t1\t1\n\t1\t1\nNA\t1\t1\nCST\tx\t.\n"))
    assert as_dict(df) == {("af", "md_mean"): 0.0007}


def test_id_column_order_is_fixed(spark):
    df = rec.bundle_table_records(rows(spark, "x.csv", "name,bundle_name,mean_fa\n5,AF,1\n"))
    assert as_dict(df) == {("af", "name"): 5.0, ("af", "fa_mean"): 1.0}
    df = rec.bundle_table_records(rows(spark, "x.csv", "what,mean_fa\nAF,1\n"))
    assert as_dict(df) == {("af", "fa_mean"): 1.0}


def test_header_only_gives_no_records(spark):
    assert rec.bundle_table_records(rows(spark, "x_bundle_means.tsv", "bundle_name\n")).count() == 0
    assert rec.bundle_table_records(rows(spark, "x_bundle_means.tsv", "bundle_name\nAF\n")).count() == 0


def test_along_tract_equals_pandas(spark):
    frame = pd.DataFrame({
        "AF_left": np.linspace(0.3, 0.45, 100), "AF-right": np.linspace(0.35, 0.48, 100),
        "CST left": [None, *np.linspace(0.4, 0.55, 99)],
    })
    df = rec.tractometry_records(rows(spark, "x_tractometry.csv", frame.to_csv()), scalar_name="fa")
    got = as_dict(df)
    assert len(got) == 6
    for column, bundle in (("AF_left", "af_left"), ("AF-right", "af_right"), ("CST left", "cst_left")):
        assert got[(bundle, "fa_mean")] == pytest.approx(frame[column].mean())
        assert got[(bundle, "fa_std")] == pytest.approx(frame[column].std())
    nodes = {r["bundle"]: r["n_nodes"] for r in df.collect()}
    assert nodes == {"af_left": 100, "af_right": 100, "cst_left": 99}


def test_along_tract_edges(spark):
    df = rec.tractometry_records(rows(
        spark, "Tractometry_MD.csv", "0,AF_left,CST_left,empty_l\n0,1,x,\n1,,,\n"))
    assert as_dict(df) == {("af_left", "md_mean"): 1.0, ("af_left", "md_std"): None}


def test_per_bundle_stats(spark):
    df = rec.tractometry_records(rows(
        spark, "x-od.csv", "label,bundle,mean,std\nq,AF,1,n/a\nq,CST,bad,2\nq,,3,3\n"))
    assert as_dict(df) == {("af", "od_mean"): 1.0, ("af", "od_std"): None, ("cst", "od_std"): 2.0}


def test_layouts(spark):
    def layout(header):
        df = spark.createDataFrame([(header.split(","),)], "h array<string>")
        return df.select(rec.tract_layout(df["h"]).alias("l")).first()["l"]

    assert layout("af_left,cst_right") == "along_tract"
    assert layout("tract_a,tract_b") == "along_tract"
    assert layout("bundle,mean,std") == "bundle_stats"
    assert layout("bundle,mean_left,mean_right") == "along_tract"
    assert layout("name,value") is None
    forced = rec.tractometry_records(
        rows(spark, "x-fa.csv", "bundle,mean,mean_left,mean_right\nAF,1,2,3\n"), layout="bundle_stats")
    assert as_dict(forced) == {("af", "fa_mean"): 1.0}


def test_registered_format(spark):
    formats = rec.register_format(
        "toy", 0, r"_toy\.csv$",
        lambda r: r.selectExpr("subject", "session", "'b' as bundle", "'s' as scalar",
                               "double(values[0]) as value"))
    assert [f.name for f in formats] == ["bundle_means", "toy", "scalarstats", "tractometry"]
    frame = rows(spark, "x_toy.csv", "v\n4\n").selectExpr("*", "'toy' as source_type")
    got = rec.parse_bundles(frame, formats).collect()
    assert [(r["bundle"], r["value"], r["bundle_source"]) for r in got] == [("b", 4.0, "toy")]


def test_typed_records_have_no_nan(spark):
    df = spark.sql("select 's' as subject, 'nan' as value union all select 't', 'x' union all select 'u', '2'")
    assert {r["subject"]: r["value"] for r in rec.as_records(df).collect()} == {"s": None, "t": None, "u": 2.0}


def test_problems_name_the_file(spark):
    got = rec.file_problems(rows(spark, "x_bundle_means.tsv", "")).first()
    assert got["message"].startswith("parse_error:x_bundle_means.tsv:Could not read ")
