import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scalargrid.functions.flags import NO_MODEL_DATA
from scalargrid.operators import collate as col
from scalargrid.operators import metadata as meta
from scalargrid.sources.tables import table_rows

SCHEMA = ("subject string, session string, bundle string, scalar string, value double, "
          "recon_suffix string, path string, row long, column int")


def records(spark, rows=None):
    if rows is None:
        rows = [(s, "ses-1mo", b, c, v, "NODDI", "/p", i, 0) for i, s in enumerate(("sub-01", "sub-02"))
                for b in ("af_left", "cst_left") for c, v in (("fa_mean", 0.38), ("icvf_mean", 0.42))]
    return spark.createDataFrame(rows, SCHEMA)


def axis(spark, column, *values):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def axes(spark, subjects, sessions):
    return axis(spark, "subject", *subjects), axis(spark, "session", *sessions)


@pytest.mark.parametrize("limit", [4096, 0])
def test_grid_marks_gaps(spark, limit):
    df = col.complete_grid(records(spark), *axes(spark, ["sub-01"], ["ses-1mo", "ses-6mo"]), limit=limit)
    rows = df.collect()
    assert len(rows) == 1 * 2 * 2 * 2
    assert all(r["scalar_present"] == (r["session"] == "ses-1mo") for r in rows)
    assert all(r["value"] is None for r in rows if not r["scalar_present"])


def test_grid_keeps_duplicates_and_drops_strangers(spark):
    twice = [("sub-01", "ses-1", "a", "x", v, "R", "/p", i, 0) for i, v in enumerate((1.0, 2.0))]
    other = [("sub-09", "ses-1", "b", "y", 3.0, "R", "/p", 0, 0)]
    df = col.complete_grid(records(spark, twice + other), *axes(spark, ["sub-01"], ["ses-1"]))
    got = sorted((r["bundle"], r["scalar"], r["value"] or 0) for r in df.collect())
    assert got == [("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", 0), ("b", "x", 0), ("b", "y", 0)]


def test_no_records_give_an_empty_table_with_columns(spark):
    df = col.complete_grid(records(spark, []), *axes(spark, ["sub-01"], ["ses-1"]))
    assert df.count() == 0 and set(col.LONG_KEYS) <= set(df.columns)
    assert col.complete_wide(records(spark, []), *axes(spark, ["s"], ["t"])).count() == 0


def test_grid_needs_no_shuffle_of_records(spark):
    df = col.complete_grid(records(spark), *axes(spark, ["sub-01"], ["ses-1mo"]), closed=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_first_value_wins_in_wide(spark):
    rows = [("s", "t", "b", "x", v, r, p, i, 0) for v, r, p, i in
            ((3.0, "B", "/1", 0), (2.0, "A", "/2", 1), (1.0, "A", "/2", 2), (None, "A", "/1", 0))]
    got = col.wide_table(records(spark, rows), keep=["recon_suffix"]).first()
    assert (got["x"], got["recon_suffix"]) == (2.0, "A")


def test_any_number_of_scalars_goes_wide(spark):
    cells = spark.range(10_001).selectExpr(
        "'s' as subject", "'t' as session", "string(null) as bundle", "concat('c', id) as scalar",
        "double(id) as value", "'R' as recon_suffix", "'/p' as path", "id as row", "0 as column")
    wide = col.wide_table(cells)
    assert len(wide.columns) == 3 + 10_001
    assert tuple(wide.select("c7", "c10000").first()) == (7.0, 10000.0)


def test_long_axes_give_the_same_grid(spark):
    rows = [("s1", "t1", b, c, 1.0, "R", "/p", 0, 0) for b, c in (("b1", "c1"), ("b2", "c2"), ("b3", "c3"))]
    frames = [col.complete_grid(records(spark, rows), *axes(spark, ["s1", "s2"], ["t1", "t2"]), limit=n) for n in (100, 2, 1)]
    found = [sorted(map(str, f.select(*col.LONG_KEYS, "scalar_present").collect())) for f in frames]
    assert len(found[0]) == 36 and found[0] == found[1] == found[2]


def test_wide_is_rectangular_unless_asked(spark):
    a = axes(spark, ["sub-01", "sub-02"], ["ses-1mo", "ses-6mo"])
    assert col.complete_wide(records(spark), *a).count() == 8
    rows = records(spark, [("sub-01", "ses-1mo", "b", c, v, "R", "/p", 0, 0) for c, v in (("x", 1.0), ("y", None))])
    kept = col.complete_wide(rows, *a, drop_empty=True)
    assert kept.columns == ["subject", "session", "bundle", "x"] and kept.count() == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(*[st.sampled_from("abc")] * 4), st.floats(-9, 9), min_size=1, max_size=20))
def test_pivot_and_melt_are_inverse(spark, cells):
    df = records(spark, [(*k, v, "R", "/p", 0, 0) for k, v in cells.items()])
    wide = col.wide_table(df)
    names = [c for c in wide.columns if c not in col.BUNDLE_KEYS]
    back = wide.unpivot(list(col.BUNDLE_KEYS), names, "scalar", "value").where("value is not null")
    assert {tuple(r)[:4]: r["value"] for r in back.collect()} == cells
    subjects, sessions = df.select("subject"), df.select("session")
    n = [len({k[i] for k in cells}) for i in range(4)]
    assert col.complete_grid(df, subjects, sessions).count() == n[0] * n[1] * n[2] * n[3]


def test_one_key_with_a_third_of_all_rows(spark):
    many = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 's0', concat('s', id % 50)) as subject", "concat('t', id % 2) as session",
        "'b' as bundle", "if(id % 3 = 0, 'x', concat('c', id % 5)) as scalar", "double(id) as value", "id")
    subjects, sessions = many.select("subject"), many.select("session")
    grid = col.complete_grid(many, subjects, sessions)
    present = grid.where("scalar_present")
    assert present.count() == 30_000
    keys = many.select(*col.LONG_KEYS).distinct().count()
    assert grid.count() - 30_000 == subjects.distinct().count() * 2 * 6 - keys
    first = col.wide_table(many, order=["id"]).where("subject = 's0' and session = 't0'").first()
    assert first["x"] == 0.0


def test_missing_policy(spark):
    missing = col.missing_sessions(records(spark), *axes(spark, ["sub-01"], ["ses-1mo", "ses-6mo"]))
    warned = col.apply_missing_policy(missing, "warn").collect()
    assert [(r["subject"], r["session"], r["message"]) for r in warned] == [("sub-01", "ses-6mo", "no_scalar_data")]
    assert col.apply_missing_policy(missing, "ignore").count() == 0
    with pytest.raises(RuntimeError, match="No scalar data found for sub-01 ses-6mo"):
        col.apply_missing_policy(missing, "error")
    with pytest.raises(ValueError):
        col.apply_missing_policy(missing, "other")


def test_session_metadata_sets_flags_after_ages(spark):
    spine = spark.createDataFrame([("s", "1"), ("s", "2")], "subject string, session string")
    sidecars = spark.createDataFrame([("s", "1", 1.7, None)],
                                     "subject string, session string, noddi_d_par double, noddi_modulated_present boolean")
    ages = spark.createDataFrame([("s", "1", 1.0)], "subject string, session string, session_age_months double")
    got = {r["session"]: r for r in col.session_metadata(spine, sidecars, None, ages).collect()}
    assert got["1"]["noddi_d_par_flag"] == "WARN:adult_default_d_par_in_infant"
    assert got["2"]["noddi_d_par_flag"] == "UNKNOWN:sidecar_missing"
    assert got["1"]["noddi_modulated_present"] is False
    bare = col.session_metadata(spine).first()
    assert bare["noddi_d_par_flag"] == NO_MODEL_DATA and bare["session_age_months"] is None


def test_keep_first(spark):
    df = spark.createDataFrame([("s", "1", 2, "b"), ("s", "1", 1, None)], "subject string, session string, o int, v string")
    assert [tuple(r) for r in col.keep_first(df, ["o"]).collect()] == [("s", "1", 1, None)]


def test_priority_columns_lead(spark):
    df = col.collate(records(spark), *axes(spark, ["sub-01"], ["ses-1mo"]))
    assert df.columns[:6] == ["subject", "session", "bundle", "scalar", "value", "scalar_present"]
    assert "path" not in df.columns
    wide = col.collate(records(spark), *axes(spark, ["sub-01"], ["ses-1mo"]), scalar_format="wide")
    assert wide.columns == ["subject", "session", "bundle", "fa_mean", "icvf_mean", "recon_suffix"]
    with pytest.raises(ValueError):
        col.collate(records(spark), *axes(spark, ["s"], ["t"]), scalar_format="other")


def ages(spark, text):
    df = spark.createDataFrame([("/p/sub-01/sessions.tsv", "sub-01", text)], "path string, subject string, content string")
    return {r["session"]: r["session_age_months"] for r in meta.session_ages(table_rows(df, "lower")).collect()}


def test_ages(spark):
    assert ages(spark, "Session_ID \tAge_months\n1mo\t1\nses-6mo\t6.5\n") == {"ses-1mo": 1.0, "ses-6mo": 6.5}
    assert ages(spark, "ses\tage\tage_months\na\t9\t1\n") == {"ses-a": 1.0}
    assert ages(spark, "ses\tage\na\t1\na\t2\na\tsoon\nb\t1\nb\tn/a\n") == {"ses-a": 2.0, "ses-b": None}
    assert ages(spark, "ses\theight\na\t1\n") == {}
    assert ages(spark, "visit\tage\na\t1\n") == {}


def test_versions(spark):
    schema = "path string, content string"
    prep = spark.createDataFrame([("/p/dataset_description.json", '{"Version": "1"}')], schema)
    recon = spark.createDataFrame(
        [(f"/r/qsirecon-{s}/dataset_description.json", c) for s, c in
         (("C", '{"Version": "3"}'), ("B", '{"GeneratedBy": [{"Version": "2"}]}'), ("A", "{bad"))], schema)
    base = spark.range(2)
    assert [tuple(r)[1:] for r in meta.add_versions(base, prep, recon).collect()] == [("1", "2")] * 2
    none = prep.limit(0)
    assert meta.add_versions(base, none, none).first()["qsirecon_version"] == "unknown"
