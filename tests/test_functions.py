import math

import pytest
from pyspark.sql import functions as F

from scalargrid.functions import cells, flags, names, sidecar_json


def evaluate(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, number",
    [
        ("0.38", 0.38), (" 1e-3 ", 0.001), ("-.5", -0.5), ("+2.", 2.0), ("7", 7.0),
        ("inf", math.inf), ("-Infinity", -math.inf),
        ("nan", None), ("n/a", None), ("", None), (None, None), ("1.0d", None), ("1f", None),
        ("0x1p3", None), ("1_0", None), ("1,5", None), ("1-2", None), ("abc", None), (".", None),
        ("-", None), ("1/2", None),
    ],
)
def test_to_number(spark, text, number):
    assert evaluate(spark, cells.to_number, text) == number


@pytest.mark.parametrize("text", ["", " ", "NaN", "NA", "n/a", "None", "NULL", ".", "#N/A", None])
def test_is_missing(spark, text):
    assert evaluate(spark, cells.is_missing, text) is True


def test_normalised_names(spark):
    assert evaluate(spark, cells.normalise_header, " Mean FA\t") == "mean_fa"
    assert evaluate(spark, cells.normalise_bundle, " AF left-x ") == "af_left_x"


@pytest.mark.parametrize(
    "raw, canonical",
    [
        ("mean_fa", "fa_mean"), ("std_fa", "fa_std"), ("dti_fa", "fa_mean"), ("gfa", "gfa_mean"),
        ("mean_odd_name", "odd_name_mean"), ("std_x", "x_std"), ("exotic_metric", "exotic_metric"),
        ("mean_length", "length_mean"), ("volume", "volume"),
    ],
)
def test_canonical_scalar(spark, raw, canonical):
    assert evaluate(spark, names.canonical_scalar, raw) == canonical


def test_shape_stat_keeps_the_raw_name(spark):
    assert evaluate(spark, names.is_shape_stat, "mean_length") is True
    assert evaluate(spark, names.is_shape_stat, "length_mean") is False


@pytest.mark.parametrize(
    "file, scalar",
    [("Tractometry_MD.csv", "md"), ("x-odi.csv", "odi"), ("sub-01_tractometry.csv", "unknown"),
     ("nofa.csv", "unknown")],
)
def test_scalar_from_file(spark, file, scalar):
    assert evaluate(spark, names.scalar_from_file, file) == scalar


def test_source_from_file(spark):
    assert evaluate(spark, names.source_from_file, "x_bundles-A_ScalarStats.csv") == "scalarstats"
    assert evaluate(spark, names.source_from_file, "other.tsv") == "bundle_means"


def test_labels(spark):
    assert evaluate(spark, lambda c: cells.strip_label(c, "sub-"), "sub-01") == "01"
    assert evaluate(spark, lambda c: cells.strip_label(c, "sub-"), "x-sub-01") == "x-sub-01"
    assert evaluate(spark, lambda c: cells.with_label(c, "ses-"), "1mo") == "ses-1mo"
    assert evaluate(spark, lambda c: cells.with_label(c, "ses-"), "ses-1mo") == "ses-1mo"


def test_share(spark):
    row = spark.sql("select 9L as a, 99L as b, 0L as z")
    got = row.select(
        cells.share(F.col("a"), F.col("b")).alias("s"), cells.share(F.col("z"), F.col("z")).alias("n")
    ).first()
    assert (got["s"], got["n"]) == (0.090909, None)


@pytest.mark.parametrize(
    "content, version",
    [
        ('{"GeneratedBy": [{"Version": "1.1"}], "Version": "2"}', "1.1"),
        ('{"GeneratedBy": [{"Version": ""}], "Version": "2"}', "2"),
        ('{"GeneratedBy": {"Version": "1.1"}}', "unknown"),
        ('{"Version": "2"}', "2"), ("{}", "unknown"), ("{bad", "unknown"),
    ],
)
def test_dataset_version(spark, content, version):
    assert evaluate(spark, sidecar_json.dataset_version, content) == version


@pytest.mark.parametrize(
    "content, readable", [('{"a": 1}', True), ("{}", False), ("[1]", False), ("{bad", False), ("", False)]
)
def test_json_validity(spark, content, readable):
    assert evaluate(spark, lambda c: sidecar_json.has_fields(sidecar_json.json_fields(c)), content) is readable


@pytest.mark.parametrize(
    "d_par, age, expected, flag",
    [
        (1.7, 1.0, 1.7, "WARN:adult_default_d_par_in_infant"),
        (1.7, None, 1.7, "INFO:adult_default_d_par"),
        (1.7, math.nan, 1.7, "INFO:adult_default_d_par"),
        (1.7, 36.0, 1.7, "INFO:adult_default_d_par"),
        (1.5, 1.0, 1.5, "OK:custom_d_par_matches_expected"),
        (2.1, 12.0, 1.7, "WARN:unexpected_d_par:2.1000"),
        (None, 6.0, 1.7, "UNKNOWN:sidecar_missing"),
        (math.nan, 6.0, 1.7, "UNKNOWN:sidecar_missing"),
        (1.7, 18.0, 1.7, "WARN:adult_default_d_par_in_infant"),
        (1.7000001, 18.1, 1.7, "INFO:adult_default_d_par"),
    ],
)
def test_flag(spark, d_par, age, expected, flag):
    df = spark.createDataFrame([(d_par, age)], "d double, a double")
    got = df.select(flags.assumption_flag(F.col("d"), F.col("a"), 18.0, expected).alias("f")).first()
    assert got["f"] == flag
