import json

import pytest

from scalargrid.operators import qc
from scalargrid.operators import sidecars as side
from scalargrid.sources.tables import table_rows

KEYS = ("sub-01", "ses-1mo")


def reduce(spark, *files):
    df = spark.createDataFrame(
        [(*KEYS, f"/d/{n}_dwimap.json", c) for n, c in files],
        "subject string, session string, path string, content string")
    fields = side.sidecar_fields(df)
    return side.reduce_sidecars(fields).collect(), side.sidecar_problems(fields).collect()


def noddi(**fields):
    return json.dumps(fields)


def test_sidecars(spark):
    got, problems = reduce(
        spark, *[(f"model-noddi_param-{p}", noddi(d_par=1.7, d_iso=3.0)) for p in ("icvf", "isovf", "od")],
        ("model-noddi_desc-modulated_param-icvf", noddi(d_par=1.7)))
    assert len(got) == 1 and not problems
    assert got[0].asDict() == {
        "subject": "sub-01", "session": "ses-1mo", "noddi_d_par": 1.7, "noddi_d_iso": 3.0,
        "noddi_modulated_present": True, "noddi_sidecar_count": 4,
        "dti_fitting_method": None, "dti_sidecar_count": None}


def test_first_value_by_path_and_alias_order(spark):
    got, _ = reduce(
        spark, ("b_model-noddi", noddi(dPar=2.0)),
        ("a_model-noddi", noddi(d_par=None, intrinsic_diffusivity="1.5", dPar=9)),
        ("0_model-noddi", "{bad"), ("1_model-noddi", "{}"))
    assert got[0]["noddi_d_par"] == 1.5 and got[0]["noddi_sidecar_count"] == 4
    assert got[0]["noddi_modulated_present"] is False


def test_unreadable_modulated_file_does_not_count(spark):
    got, _ = reduce(spark, ("model-noddi_desc-modulated", "{bad"), ("model-noddi", noddi(Model="x")))
    assert got[0]["noddi_modulated_present"] is False and got[0]["noddi_d_par"] is None


def test_text_parameter_keeps_the_rest(spark):
    got, problems = reduce(spark, ("model-noddi", noddi(d_par="abc", d_iso=3)))
    assert got[0]["noddi_d_par"] is None and got[0]["noddi_d_iso"] == 3.0
    assert problems[0]["message"] == "dwimap_json_error:could not convert string to float: 'abc'"


def test_tensor_sidecars(spark):
    got, _ = reduce(
        spark, ("0_model-tensor", "{bad"), ("a_model-tensor", noddi(Method="OLS", FittingMethod="WLS")),
        ("b_model-tensor", noddi(method="X")))
    assert got[0]["dti_fitting_method"] == "WLS" and got[0]["dti_sidecar_count"] == 3
    assert got[0]["noddi_sidecar_count"] is None and got[0]["noddi_modulated_present"] is None
    got, _ = reduce(spark, ("a_model-tensor", noddi(Model="t")), ("b_model-tensor", noddi(method="X")))
    assert got[0]["dti_fitting_method"] is None
    assert reduce(spark, ("model-dki", noddi(d_par=1)))[0] == []


def rows(spark, content, **options):
    df = spark.createDataFrame([(*KEYS, "/d/x.tsv", content)],
                               "subject string, session string, path string, content string")
    return table_rows(df, **options)


def test_image_qc_takes_the_first_row(spark):
    got = qc.image_qc(rows(spark, "mean_fd\tmax fd\tt1_neighbor_corr\tmax_fd\n0.35\t9\t0.87\tn/a\n9\t9\t9\t9\n")).first()
    assert got["qc_mean_fd"] == 0.35 and got["qc_ndc"] == 0.87 and got["qc_num_bad_slices"] is None
    assert len(got) == 2 + 12


def test_legacy_names_win(spark):
    got = qc.image_qc(rows(spark, "t1_neighbor_corr\tneighbor_corr\tnum_bad_slices\n0.8\t0.9\t4\n")).first()
    assert got["qc_ndc"] == 0.9 and got["qc_num_bad_slices"] == 4.0
    got = qc.image_qc(rows(spark, "t1_neighbor_corr\tneighbor_corr\n0.8\tn/a\n")).first()
    assert got["qc_ndc"] is None
    assert qc.image_qc(rows(spark, "other\n1\n")).count() == 0


def censor(spark, text, threshold=0.5):
    return [tuple(r)[2:] for r in
            qc.censoring_summary(rows(spark, text, header_style="raw", keep_empty=True), threshold).collect()]


def test_censoring(spark):
    text = "framewise_displacement\n" + "0.2\n" * 90 + "0.8\n" * 9
    assert censor(spark, text) == [(99, 9, 0.090909, 0.5)]
    assert censor(spark, "framewise_displacement\n0.5\nn/a\nnan\n0.6\n") == [(4, 1, 0.25, 0.5)]
    assert censor(spark, "framewise_displacement\n") == [(0, 0, None, 0.5)]
    assert censor(spark, "Framewise_Displacement\n1\n") == []
    assert censor(spark, "other\n1\n") == []


def group(spark, columns, *rows_):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows_)], "_row_order int, " + ", ".join(f"{c} string" for c in columns))


def lookup(spark, table, *sessions):
    spine = spark.createDataFrame(list(sessions), "subject string, session string")
    return {(r["subject"], r["session"]): tuple(r)[2:] for r in qc.group_lookup(spine, table).collect()}


def test_group_lookup_by_id(spark):
    table = group(spark, ("subject_id", "session_id", "run_id", "efc", "site"),
                  ("01", "ses-1", "1", "0.4", "n"), ("sub-01", "1", "2", "9", "s"), ("10", "1", "1", "n/a", ""))
    got = lookup(spark, table, ("sub-01", "ses-1"), ("sub-1", "ses-1"), ("sub-10", "ses-1"),
                 ("sub-10", "_no_session"), ("sub-01", "ses-2"))
    assert got == {("sub-01", "ses-1"): (0.4, "n"), ("sub-10", "ses-1"): (None, None),
                   ("sub-10", "_no_session"): (None, None)}


def test_group_lookup_by_scan_name(spark):
    table = group(spark, ("bids_name", "fd"), ("sub-10_dwi", "10"), ("sub-1_dwi", "1"), ("sub-2", "2"))
    assert lookup(spark, table, ("sub-1", "ses-1"), ("sub-2", "_no_session"), ("sub-3", "ses-1")) == {
        ("sub-1", "ses-1"): (1.0,), ("sub-2", "_no_session"): (2.0,)}


def test_group_lookup_without_ids(spark):
    table = group(spark, ("fd",), ("3",), ("4",))
    assert lookup(spark, table, ("sub-1", "ses-1"), ("sub-2", "ses-2")) == {
        ("sub-1", "ses-1"): (3.0,), ("sub-2", "ses-2"): (3.0,)}
    table = group(spark, ("session_id", "fd"), ("2", "3"), ("1", "4"))
    assert lookup(spark, table, ("sub-1", "ses-1"), ("sub-2", "_no_session")) == {
        ("sub-1", "ses-1"): (4.0,), ("sub-2", "_no_session"): (3.0,)}


def test_one_type_per_group_column(spark):
    table = group(spark, ("subject_id", "a", "b"), ("1", "1", "1"), ("2", "n/a", "x"))
    assert lookup(spark, table, ("sub-1", "s"), ("sub-2", "s")) == {
        ("sub-1", "s"): (1.0, "1"), ("sub-2", "s"): (None, "x")}


def test_merge_qc(spark):
    a = spark.createDataFrame([("s", "1", 1.0)], "subject string, session string, x double")
    b = spark.createDataFrame([("s", "2", 2.0)], "subject string, session string, y double")
    assert sorted(map(tuple, qc.merge_qc(a, None, b).collect())) == [
        ("s", "1", 1.0, None), ("s", "2", None, 2.0)]


def test_many_qc_files_warn(spark):
    chosen = spark.createDataFrame([(*KEYS, "/d/a.tsv", True), (*KEYS, "/d/b.tsv", False)],
                                   "subject string, session string, qc_path string, many_qc_files boolean")
    assert [r["message"] for r in qc.qc_problems(chosen).collect()] == ["multiple_qc_files:using a.tsv"]


@pytest.mark.parametrize("text", ["", "mean_fd\n"])
def test_no_rows_no_qc(spark, text):
    assert qc.image_qc(rows(spark, text)).count() == 0
