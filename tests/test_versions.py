"""Readers see one whole version, whatever happens to the job that writes the next."""

import os

import pytest

from scalargrid import run
from scalargrid.sources import sinks, versions


def _write(spark, folder, value, keep=2):
    version = versions.new_version(folder)
    spark.range(value).write.parquet(f"{version}/t")
    versions.publish(spark, version, keep)
    return version


def test_a_failed_job_leaves_the_former_version(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        versions.published(spark, out)
    first = run(spark, *tree[:2], out, keep_versions=2)
    rows = sorted(map(str, first.collect()))
    former = versions.published(spark, out)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "write_run_log", fails)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, *tree[:2], out, keep_versions=2, subjects=["B2"])
    assert versions.published(spark, out) == former and len(os.listdir(f"{out}/_versions")) == 2
    assert sorted(map(str, sinks.read_table(first, former).collect())) == rows
    run(spark, *tree[:2], out, keep_versions=2, subjects=["B2"])
    now = versions.published(spark, out)
    assert now != former and versions.versions(spark, out) == [now, former]
    assert {r["subject"] for r in sinks.read_table(first, now).select("subject").collect()} == {"sub-B2"}
    assert sorted(map(str, sinks.read_table(first, former).collect())) == rows


def test_a_job_that_ends_before_the_rename_publishes_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    kept = _write(spark, folder, 3)
    half = versions.new_version(folder)
    spark.range(9).write.parquet(f"{half}/t")
    (tmp_path / "out" / f"_published-{half.rsplit('/', 1)[1]}").write_text("half a na")
    assert versions.published(spark, folder) == kept
    assert spark.read.parquet(f"{versions.published(spark, folder)}/t").count() == 3


def test_older_versions_go(spark, tmp_path):
    folder = str(tmp_path / "out") + "/"
    made = [_write(spark, folder, i) for i in range(1, 5)]
    assert versions.versions(spark, folder) == [made[3], made[2]]
    assert sorted(os.listdir(f"{folder}_versions")) == sorted(v.rsplit("/", 1)[1] for v in made[2:])
    versions.publish(spark, made[2], keep=1)  # back to the former one
    assert versions.versions(spark, folder) == [made[2]] and os.listdir(f"{folder}_versions") == [made[2].rsplit("/", 1)[1]]
    with pytest.raises(ValueError):
        versions.publish(spark, made[2], keep=0)
