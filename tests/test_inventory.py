from scalargrid.operators import inventory as inv

ROOT = "/data/recon/derivatives/qsirecon-"


def located(spark, *paths, root="/data/recon"):
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return inv.resolve_sessions(inv.with_entities(files, root))


def test_entities(spark):
    got = located(
        spark, ROOT + "NODDI/sub-01/ses-1/dwi/a_bundle_means.tsv", ROOT + "DTI/sub-02/dwi/b.json",
    ).unionByName(located(spark, "file:/data/preproc/sub-03/ses-2/anat/c.txt", root="/data/preproc/")).orderBy("subject").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("NODDI", "sub-01", "ses-1", "a_bundle_means.tsv", True),
        ("DTI", "sub-02", "_no_session", "b.json", True),
        ("unknown", "sub-03", "ses-2", "c.txt", False),
    ]


def test_session_layer_hides_the_subject_folder(spark):
    got = located(spark, ROOT + "A/sub-01/dwi/x", ROOT + "A/sub-01/ses-1/dwi/y", ROOT + "B/sub-01/dwi/z")
    assert {(r["recon_suffix"], r["session"]) for r in got.collect()} == {
        ("A", "ses-1"), ("B", "_no_session")}


def test_root_branch(spark):
    nested, flat = ROOT + "A/sub-01/dwi/x", "/data/recon/qsirecon-A/sub-01/dwi/x"
    both = spark.createDataFrame([(nested,), (flat,)], "path string")
    assert [r[0] for r in inv.below_derivatives(both, "/data/recon").collect()] == [nested]
    assert inv.below_derivatives(both.where(both.path == flat), "/data/recon").count() == 1
    # Only the place right below the root counts, whatever lies above it or deeper.
    deep = spark.createDataFrame([("/x/derivatives/qsirecon-A/sub-01/dwi/x",), ("/x/derivatives/qsirecon-A/derivatives/y",)], "path string")
    assert inv.below_derivatives(deep, "/x/derivatives").count() == 2


def test_include_lists(spark):
    files = located(spark, ROOT + "A/sub-01/ses-1/dwi/x", ROOT + "B/sub-02/ses-2/dwi/y", ROOT + "A/sub-03/dwi/z")
    assert inv.keep_labels(files).count() == 3
    assert inv.keep_labels(files, subjects=[]).count() == 3
    assert inv.keep_labels(files, subjects=["01", "03"]).count() == 2
    assert inv.keep_labels(files, sessions=["1"]).count() == 1  # the sentinel is filtered too
    assert inv.keep_labels(files, recon_suffixes=["B"]).count() == 1


def test_priority_is_per_folder_and_keeps_all_files(spark):
    a, b = ROOT + "A/sub-01/ses-1/dwi/", ROOT + "B/sub-01/ses-1/dwi/"
    files = inv.classify_files(located(
        spark, a + "1_bundle_means.tsv", a + "2_bundle_means.tsv", a + "x_bundles-D_scalarstats.csv",
        a + "x_tractometry.csv", b + "Tractometry_FA.csv", b + "x_tractometry-fa.csv",
        b + "sub-01_dwi.nii.gz", b + "x_scalarstats.csv", a.replace("dwi", "anat") + "3_bundle_means.tsv",
    ))
    auto = {(r["recon_suffix"], r["file_name"]) for r in inv.pick_bundle_files(files).collect()}
    assert auto == {("A", "1_bundle_means.tsv"), ("A", "2_bundle_means.tsv"),
                    ("B", "Tractometry_FA.csv"), ("B", "x_tractometry-fa.csv")}
    named = inv.pick_bundle_files(files, "tractometry").collect()
    assert {r["file_name"] for r in named} == {
        "x_tractometry.csv", "Tractometry_FA.csv", "x_tractometry-fa.csv"}
    assert inv.pick_bundle_files(files, "scalarstats").count() == 1


def test_sidecars_each_once(spark):
    a = ROOT + "A/sub-01/ses-1/dwi/"
    files = inv.classify_files(located(
        spark, a + "x_model-noddi_param-icvf_dwimap.json", a + "x_model-noddi_param-icvf_dwimap.json",
        a + "x_model-noddi_desc-modulated_param-od_dwimap.json",
        a + "x_model-noddi_desc-modulated_param-isovf_dwimap.json",
        a + "x_model-tensor_param-fa_dwimap.json", a + "x_model-dki_param-fa_dwimap.json"))
    got = inv.pick_sidecar_files(files).collect()
    assert sorted(r["source_type"] for r in got) == ["noddi", "noddi", "tensor"]


def qc(spark, *names):
    paths = [f"/p/sub-01/ses-{s}/dwi/{n}" for s, n in names]
    files = located(spark, *paths, root="/p")
    known = inv.classify_files(files, (), keep_others=True)
    chosen = inv.pick_qc_files(known).orderBy("session").collect()
    return [
        (r["session"], r["era"], *(p and p.split("/")[-1] for p in (r["qc_path"], r["confounds_path"])),
         r["many_qc_files"]) for r in chosen
    ]


def test_qc_files(spark):
    assert qc(
        spark, ("1", "b_desc-image_qc.tsv"), ("1", "a_desc-image_qc.tsv"), ("1", "0_desc-ImageQC_dwi.csv"),
        ("1", "x_confounds.tsv"), ("1", "y_desc-confounds_timeseries.tsv"),
        ("2", "x_desc-ImageQC_dwi.csv"), ("2", "x_confounds.tsv"), ("3", "x.nii.gz"),
    ) == [
        ("ses-1", "current", "a_desc-image_qc.tsv", "y_desc-confounds_timeseries.tsv", True),
        ("ses-2", "legacy", "x_desc-ImageQC_dwi.csv", "x_confounds.tsv", False),
        ("ses-3", "unknown", None, None, False),
    ]


def test_age_files(spark):
    files = inv.with_entities(spark.createDataFrame(
        [("/p/sub-01/sessions.tsv",), ("/p/sub-01/sub-01_sessions.tsv",), ("/p/sub-02/sessions.tsv",),
         ("/p/sub-03/sub-01_sessions.tsv",), ("/p/sub-04/ses-1/sessions.tsv",)], "path string"), "/p")
    assert sorted(tuple(r) for r in inv.pick_age_files(files).collect()) == [
        ("sub-01", "/p/sub-01/sub-01_sessions.tsv"), ("sub-02", "/p/sub-02/sessions.tsv")]


def test_labels(spark):
    files = located(spark, ROOT + "A/sub-01/ses-1/dwi/x", ROOT + "A/sub-01/ses-2/dwi/x")
    assert [r[0] for r in inv.entity_values(files, "subject").collect()] == ["sub-01"]
    assert inv.entity_values(files, "session").count() == 2


def test_only_folders_below_the_root_count(spark):
    root = "/sub-study/ses-x/recon"
    got = located(
        spark, root + "/qsirecon-A/sub-01/ses-1/dwi/sub-01_work/f.tsv", root + "/qsirecon-A/sub-01/ses-1/dwi/f.tsv",
        root + "/qsirecon-A/dataset_description.json", "file://" + root + "/derivatives/qsirecon-B/sub-02/ses-1",
        "/elsewhere/sub-03/ses-1/dwi/f.tsv", root=root,
    )
    rows = sorted(tuple(r)[1:] for r in got.collect() if r["subject"])
    assert rows == [("A", "sub-01", "ses-1", "f.tsv", False), ("A", "sub-01", "ses-1", "f.tsv", True),
                    ("B", "sub-02", "_no_session", "ses-1", False)]
