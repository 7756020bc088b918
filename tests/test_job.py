"""The whole job on a small tree, with exact rows."""

import json
import os

import pytest

from cohort import ALL_VISITS, TRACTS, VISITS, anisotropy, delimited, visits, write
from scalargrid import build, run
from scalargrid.operators.dictionary import DICTIONARY_COLUMNS, data_dictionary
from scalargrid.operators import runlog as log
from scalargrid.sources import files
from scalargrid.streaming.landing import land_rows, stream_documents


@pytest.fixture(scope="module")
def outputs(spark, tree):
    return build(spark, *tree)


@pytest.fixture(scope="module")
def table(outputs):
    return outputs.table.collect()


def test_grid_is_complete(table):
    # 3 x 3 sessions, 3 bundles, 3 scalars; two keys have a row of each of two workflows.
    keys = {(r["subject"], r["session"], r["bundle"], r["scalar"]) for r in table}
    assert len(keys) == 81 and len(table) == 83
    gaps = [r for r in table if not r["scalar_present"]]
    assert len(gaps) == 81 - 6 * 3 * 2 - 2 and all(r["value"] is None for r in gaps)
    assert {r["subject"] for r in table} == set(VISITS)
    assert {r["session"] for r in table} == {f"ses-{v}" for v in ALL_VISITS}


def test_values(table):
    got = sorted(
        (r["subject"], r["session"], r["bundle"], r["scalar"], r["value"])
        for r in table if r["recon_suffix"] == "TRACK"
    )
    assert got == sorted(
        (subject, f"ses-{visit}", tract.lower().replace(" ", "_"), scalar, sign * anisotropy(subject, visit, tract))
        for subject, visit in visits() for tract in TRACTS for scalar, sign in (("fa_mean", 1), ("md_mean", -1))
    )
    along = {(r["bundle"], r["scalar"]): r["value"] for r in table if r["recon_suffix"] == "ALONG"}
    assert {k: round(v, 6) for k, v in along.items()} == {
        ("arc_left", "fa_mean"): 3.0, ("arc_right", "fa_mean"): 5.0,
        ("arc_left", "fa_std"): 2.645751, ("arc_right", "fa_std"): 1.732051}


def test_session_columns(table):
    rows = {(r["subject"], r["session"][4:]): r for r in table}
    names = ("noddi_d_par", "noddi_d_iso", "noddi_sidecar_count", "session_age_months", "noddi_d_par_flag",
             "qc_mean_fd", "qc_ndc", "qc_n_volumes", "qc_n_censored", "qc_pct_censored", "mriqc_efc", "mriqc_row")
    unknown = "UNKNOWN:sidecar_missing"
    assert {k: tuple(r[n] for n in names) for k, r in rows.items()} == {
        ("sub-A1", "base"): (1.7, 2.5, 1, 4.0, "WARN:adult_default_d_par_in_infant", 0.2, 0.5, 4, 2, 0.5, None, None),
        ("sub-A1", "mid"): (1.4, 2.5, 1, 20.0, "WARN:unexpected_d_par:1.4000", 0.22, 0.52, 2, 0, 0.0, None, None),
        ("sub-A1", "late"): (1.7, 2.5, 1, 41.0, "INFO:adult_default_d_par", 0.21, 0.51, 1, 1, 1.0, None, None),
        ("sub-B2", "base"): (None, None, None, 15.0, unknown, 0.2, 0.5, 4, 2, 0.5, None, None),
        ("sub-B2", "mid"): (None, None, None, None, unknown, None, None, None, None, None, None, None),
        ("sub-B2", "late"): (None, None, None, None, unknown, None, None, None, None, None, None, None),
        ("sub-C3", "base"): (None, None, None, None, unknown, None, None, None, None, None, None, None),
        ("sub-C3", "mid"): (None, None, None, None, unknown, 0.22, 0.52, 2, 0, 0.0, 5.0, "one"),
        ("sub-C3", "late"): (None, None, None, None, unknown, 0.21, 0.51, 1, 1, 1.0, 7.0, "two"),
    }
    assert {(r["qsiprep_version"], r["qsirecon_version"]) for r in table} == {("0.9.3", "2.4.0")}


def test_run_log(outputs):
    rows = {(r["subject"], r["session"][4:]): (r["status"], r["warnings"]) for r in outputs.run_log.collect()}
    seen = {k: ("ok", "") for k in visits()}
    assert rows == seen | {
        (subject, visit): ("missing", "no_scalar_data")
        for subject in VISITS for visit in ALL_VISITS if (subject, visit) not in seen}


def test_flag_counts(outputs):
    assert {r[0]: r[1] for r in outputs.flag_counts.collect()} == {
        "WARN:adult_default_d_par_in_infant": 11, "WARN:unexpected_d_par:1.4000": 9,
        "INFO:adult_default_d_par": 9, "UNKNOWN:sidecar_missing": 54}


def test_dictionary(outputs):
    rows = {r["column_name"]: r for r in outputs.dictionary.collect()}
    assert list(rows) == outputs.table.columns
    assert outputs.dictionary.columns == list(DICTIONARY_COLUMNS)
    assert rows["noddi_d_par"]["units"] == "µm²/ms"
    assert rows["mriqc_row"]["description"] == "MRIQC IQM: row"
    assert rows["mriqc_row"]["notes"] == "Auto-generated entry. dtype=string"


def test_generated_entries(spark):
    df = spark.sql("select 1 as qc_new, 2 as noddi_new, 'x' as my_scalar")
    assert [r["description"] for r in data_dictionary(df).collect()] == [
        "QSIPrep QC metric: new", "NODDI model parameter: new", "Auto-documented column: my_scalar"]


def test_write_and_read_back(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    table = run(spark, *tree[:2], out, tree[2], parquet=True, sort=True, scalar_format="wide",
                subjects=["A1", "C3"], sessions=["mid"], missing_session_policy="error")
    assert table.count() == 2 * 3
    csv = spark.read.option("header", True).csv(f"{out}/scalars_longitudinal.csv")
    assert csv.count() == 6 and csv.columns == table.columns
    assert spark.read.parquet(f"{out}/scalars_longitudinal.parquet").count() == 6
    keys = [tuple(r) for r in csv.select("subject", "session", "bundle").collect()]
    assert keys == sorted(keys)
    logged = spark.read.option("header", True).option("sep", "\t").csv(f"{out}/run_log.tsv")
    assert logged.count() == 2 and logged.columns[0] == "subject"
    assert spark.read.option("header", True).csv(f"{out}/data_dictionary.csv").count() == len(table.columns)


def test_every_tree_is_listed_twice_at_most(spark, tree, monkeypatch):
    """Once for the inventory, once for all contents."""
    loads = []
    load = files._load
    monkeypatch.setattr(files, "_load", lambda *a, **b: loads.append(a[2]) or load(*a, **b))
    build(spark, *tree)
    assert len(loads) == 4 and len({tuple(g) for g in loads}) == 2


def test_run_leaves_no_intermediate_tables(spark, tree, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    table = run(spark, *tree[:2], str(tmp_path / "out"), subjects=["B2"], include_qc=False)
    assert set(os.listdir(shared)) == before
    assert table.count() == 3 * 2 and table.where("scalar_present").count() == 6


def test_filters_switches_and_policies(spark, tree):
    out = build(spark, *tree[:2], subjects=["A1"], recon_suffixes=["TRACK", "MODEL"], include_qc=False,
                include_data_dictionary=False, infant_threshold_months=0.5)
    rows = out.table.collect()
    assert {r["subject"] for r in rows} == {"sub-A1"} and "qc_mean_fd" not in out.table.columns
    assert {r["noddi_d_par_flag"] for r in rows} == {"INFO:adult_default_d_par", "WARN:unexpected_d_par:1.4000"}
    assert out.dictionary is None
    assert {r["status"] for r in out.run_log.collect()} == {"partial"}
    with pytest.raises(RuntimeError, match="sub-B2 ses-late"):
        build(spark, *tree[:2], missing_session_policy="error", include_qc=False)
    empty = build(spark, *tree[:2], bundle_source="scalarstats", include_qc=False)
    assert empty.table.count() == 0 and "scalar_present" in empty.table.columns


def test_problems_of_every_source_are_logged(spark, tmp_path):
    prep, flow = tmp_path / "prep" / "sub-1" / "ses-a" / "dwi", tmp_path / "recon" / "qsirecon-X" / "sub-1" / "ses-a" / "dwi"
    write(prep / "x_desc-image_qc.tsv", "\n")
    write(prep / "x_desc-confounds_timeseries.tsv", "framewise_displacement\n1\t2\n")
    write(tmp_path / "prep" / "sub-1" / "sessions.tsv", "age\n1\t2\n")
    write(flow / "x_tractometry.csv", "a\n1\n")
    write(flow / "x_model-noddi_param-od_dwimap.json", "{bad")
    logged = build(spark, str(tmp_path / "prep"), str(tmp_path / "recon")).run_log.collect()
    assert len(logged) == 1
    begins = [w.split(":")[0] for w in logged[0]["warnings"].split("|")]
    assert begins == ["parse_error", "dwimap_json_error", "confounds_error", "qc_error", "sessions_error"]


def test_only_the_first_quality_row_counts(spark, tmp_path):
    dwi = tmp_path / "prep" / "sub-1" / "ses-a" / "dwi"
    write(dwi / "x_desc-image_qc.tsv", "mean_fd\n0.5\n0.6\t7\n")
    flow = tmp_path / "recon" / "qsirecon-X" / "sub-1" / "ses-a" / "dwi"
    write(flow / "x_bundle_means.tsv", "bundle_name\tmean_fa\nAF\t1\n")
    assert [r["qc_mean_fd"] for r in build(spark, str(tmp_path / "prep"), str(tmp_path / "recon")).table.collect()] == [0.5]


@pytest.mark.parametrize("parameters", [
    {"bundle_source": "x"}, {"scalar_format": "x"}, {"missing_session_policy": "x"},
    {"infant_threshold_months": -1}, {"fd_threshold": 0}])
def test_parameters_are_checked(spark, tree, parameters):
    with pytest.raises(ValueError):
        build(spark, *tree, **parameters)


def test_irregular_tree(spark, tmp_path):
    """Flat root, no sessions, legacy names, bad files, several formats and workflows."""
    prep, recon = tmp_path / "prep", tmp_path / "recon"
    for sub in ("sub-1", "sub-10"):
        dwi = prep / sub / "dwi"
        write(dwi / "x_desc-ImageQC_dwi.csv", "neighbor_corr,num_bad_slices\n0.9,2\n")
        write(dwi / "x_confounds.tsv", "framewise_displacement\n0.6\n0.1\n")
    write(prep / "dataset_description.json", "{bad")
    for suffix, name, text in (
        ("B", "x_bundle_means.tsv", "bundle_name\tmean_fa\nAF\t1\n"),
        ("A", "Tractometry_FA.csv", ",AF_left,CST_left\n0,1,2\n1,3,4\n"),
        ("A", "broken_tractometry.csv", "a,b\n1,2,3\n"),
        ("B", "x_model-noddi_param-icvf_dwimap.json", json.dumps({"d_par": "abc"})),
    ):
        write(recon / f"qsirecon-{suffix}" / "sub-1" / "dwi" / name, text)
    write(recon / "qsirecon-A" / "sub-9" / "dwi" / "x_bundle_means.tsv", "bundle_name\tmean_fa\nAF\t5\n")
    extra = spark.createDataFrame([("sub-77", "_no_session")], "subject string, session string")
    out = build(spark, str(prep), str(recon), expected_sessions=extra)
    rows = out.table.collect()
    found = {(r["subject"], r["recon_suffix"], r["bundle"], r["scalar"], round(r["value"], 6)) for r in rows if r["scalar_present"]}
    assert found == {
        ("sub-1", "B", "af", "fa_mean", 1.0), ("sub-9", "A", "af", "fa_mean", 5.0),
        ("sub-1", "A", "af_left", "fa_mean", 2.0), ("sub-1", "A", "af_left", "fa_std", 1.414214),
        ("sub-1", "A", "cst_left", "fa_mean", 3.0), ("sub-1", "A", "cst_left", "fa_std", 1.414214)}
    assert {r["subject"] for r in rows} == {"sub-1", "sub-10", "sub-9", "sub-77"}
    one = next(r for r in rows if r["subject"] == "sub-1")
    assert (one["session"], one["qc_ndc"], one["qc_num_bad_slices"], one["qc_n_censored"]) == ("_no_session", 0.9, 2.0, 1)
    assert one["qsiprep_version"] == "unknown"
    logged = {r["subject"]: r for r in out.run_log.collect()}
    assert logged["sub-1"]["status"] == "partial"
    assert logged["sub-1"]["bundle_scalar_file"].endswith("x_bundle_means.tsv")
    first, second = logged["sub-1"]["warnings"].split("|")
    assert first.startswith("parse_error:broken_tractometry.csv:") and second.startswith("dwimap_json_error:")
    assert (logged["sub-10"]["status"], logged["sub-10"]["warnings"]) == ("partial", "no_scalar_data")
    assert logged["sub-9"]["status"] == "partial" and logged["sub-77"]["status"] == "missing"


def test_status_rule(spark):
    files = spark.createDataFrame(
        [("a", "1", "bundle_scalar", "/b", 1), ("a", "1", "qc", "/q", 1), ("b", "1", "qc", "/q", 1),
         ("b", "1", "qc", None, 2), ("c", "1", "bundle_scalar", "/x", 1), ("c", "1", "bundle_scalar", "/y", 2),
         ("d", "1", "bundle_scalar", "/b", 1), ("d", "1", "qc", "/q", 1)],
        "subject string, session string, file_type string, path string, order int")
    warnings = spark.createDataFrame([("d", "1", 2, "/p", "w2"), ("d", "1", 1, "/z", "w1"), ("e", "1", 1, "/z", "w")],
                                     "subject string, session string, step int, path string, message string")
    got = {r["subject"]: (r["status"], r["bundle_scalar_file"], r["warnings"]) for r in log.run_log(files, warnings).collect()}
    assert got == {"a": ("ok", "/b", ""), "b": ("missing", "", ""), "c": ("partial", "/y", ""),
                   "d": ("partial", "/b", "w1|w2"), "e": ("missing", "", "w")}


def test_landing_parses_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    table_dir, checkpoint = str(tmp_path / "rows"), str(tmp_path / "state")
    for i in range(2):
        write(source / "sub-1" / f"{i}_bundle_means.tsv", delimited([("bundle_name", "mean_fa"), ("AF", i)]))
        land_rows(stream_documents(spark, str(source), r"_bundle_means\.tsv$"), table_dir, checkpoint).awaitTermination()
        assert spark.read.parquet(table_dir).count() == i + 1



def test_files_that_cannot_be_used_are_warnings(spark, tmp_path):
    """Without a byte, no UTF-8 text, broken (a wrong checksum): each is told, and the job goes on."""
    inside = tmp_path / "recon" / "qsirecon-W" / "sub-1"
    good = "bundle_name\tmean_fa\nArc\t1\n"
    for visit, text in (("a", good), ("b", ""), ("c", good), ("d", good)):
        write(inside / f"ses-{visit}" / "dwi" / "t_bundle_means.tsv", text)
    broken = write(inside / "ses-c" / "dwi" / "t_bundle_means.tsv", good)
    (broken.parent / ".t_bundle_means.tsv.crc").write_bytes(b"crc\x00\x00\x00\x02\x00\x01\x02\x03\x04")
    (inside / "ses-d" / "dwi" / "t_bundle_means.tsv").write_bytes(b"\xff\xfe" + good.encode())
    write(inside / "ses-a" / "dwi" / "m_model-noddi_param-od_dwimap.json", "")
    quality = tmp_path / "prep" / "sub-1" / "ses-a" / "dwi"
    write(quality / "x_desc-image_qc.tsv", "")
    write(quality / "x_confounds.tsv", "")
    write(tmp_path / "prep" / "sub-1" / "sessions.tsv", "")
    done = build(spark, str(tmp_path / "prep"), str(tmp_path / "recon"))
    log_rows = {r["session"]: (r["status"], r["warnings"]) for r in done.run_log.collect()}
    assert [k for k in log_rows] and log_rows["ses-a"][0] == "partial"
    for visit, reason in (("b", "No columns to parse from file"), ("c", "the file cannot be read"), ("d", "the file is no UTF-8 text")):
        status, warnings = log_rows[f"ses-{visit}"]
        assert status == "missing" and "parse_error:t_bundle_means.tsv:Could not read " in warnings and reason in warnings
    for kind in ("dwimap_json_error", "qc_error", "confounds_error", "sessions_error"):
        assert kind in log_rows["ses-a"][1], kind
    assert {(r["session"], r["value"]) for r in done.table.collect() if r["scalar_present"]} == {("ses-a", 1.0)}


def test_tables_that_were_passed_over_are_not_copied(spark, tmp_path):
    inside = tmp_path / "recon" / "qsirecon-W" / "sub-1" / "ses-a" / "dwi"
    write(inside / "t_bundle_means.tsv", "bundle_name\tmean_fa\nArc\t1\n")
    write(inside / "t_bundles-x_scalarstats.csv", "bundle,fa\nArc,2\n")
    (tmp_path / "prep").mkdir()
    done = build(spark, str(tmp_path / "prep"), str(tmp_path / "recon"), work_dir=str(tmp_path / "work"))
    copied = [r["path"] for p in (tmp_path / "work").glob("recon_texts-*") for r in spark.read.parquet(str(p)).collect()]
    assert [c.rpartition("/")[2] for c in copied] == ["t_bundle_means.tsv"] and done.table.count() == 1


def test_listing_has_files_without_a_byte(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x+1%.tsv").write_text("")
    (tmp_path / "a b" / "y.tsv").write_text("12")
    (tmp_path / "z.json").write_text("")
    rows = {(r["path"].rpartition("/")[2], r["file_size"]) for r in files.list_files(spark, [str(tmp_path)], r"\.tsv$").collect()}
    assert rows == {("x+1%.tsv", 0), ("y.tsv", 2)}
    read = files.read_documents(spark, [str(tmp_path)])
    missing = {(r["path"].rpartition("/")[2], r["content"]) for r in files.unread(read, files.list_files(spark, [str(tmp_path)])).collect()}
    assert missing == {("x+1%.tsv", ""), ("z.json", "")}
