"""One key with almost all rows: decisions reach them without a hot task."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from scalargrid.operators import inventory as inv
from scalargrid.operators import keyed
from scalargrid.operators import records as rec
from scalargrid.runtime import stage, stored
from scalargrid.sources.tables import line_rows

ROWS = 40_000


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for key, value in zip(old, ("-1", "false", "8"), strict=True):
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def rows_by_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def hot_paths(spark):
    """97 % of all files in one subject folder, half of them outside of a session."""
    return spark.range(ROWS, numPartitions=8).select(
        F.concat(
            F.lit("/r/qsirecon-A/sub-"), F.when(F.col("id") % 100 < 97, F.lit(0)).otherwise(F.col("id") % 400),
            F.when(F.col("id") % 2 == 0, "/ses-1").otherwise(""), F.lit("/dwi/"), "id", F.lit("_bundle_means.tsv"),
        ).alias("path")
    )


def test_session_layer_of_a_hot_folder(spark, no_broadcast):
    files = stage(inv.with_entities(hot_paths(spark), "/r"), "hot").repartition(8)
    got = inv.resolve_sessions(stage(files, "dealt"))
    counts = rows_by_task(got)
    big = [c for c in counts if c >= 100]
    assert max(big) <= 2 * median(big) and len(big) >= 4
    rows = {r["subject"]: r for r in got.groupBy("subject").agg(F.count("*").alias("n"), F.min("session").alias("s")).collect()}
    # The hot folder has sessions, so files outside of them go; a folder without any keeps all.
    hot = sum(1 for i in range(ROWS) if i % 100 < 97 and i % 2 == 0)
    assert (rows["sub-0"]["n"], rows["sub-0"]["s"]) == (hot, "ses-1")
    assert (rows["sub-97"]["n"], rows["sub-97"]["s"]) == (ROWS // 400, "_no_session")


def test_best_type_of_a_hot_session(spark, no_broadcast):
    files = inv.classify_files(inv.resolve_sessions(inv.with_entities(hot_paths(spark), "/r")))
    got = inv.pick_bundle_files(files)
    counts = [c for c in rows_by_task(got) if c >= 100]
    assert max(counts) <= 2 * median(counts)
    assert got.count() == files.count()


def test_heavy_and_light_keys_give_the_rows_of_a_plain_join(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(keyed, "HEAVY_SHARE", 10)
    rows = stage(spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 70).alias("k")), "rows")
    decided = stage(rows.groupBy("k").agg(F.count("*").alias(keyed.KEY_ROWS), F.max("id").alias("top")).where("k <> 5"), "decided")
    got = keyed.attach(rows, decided, ["k"], ["top"])
    want = rows.join(decided.select("k", "top"), "k").select("id", "k", "top")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == ["id", "k", "top"]
    assert sorted(map(tuple, keyed.attach(rows, decided.limit(0).select(*decided.columns), ["k"], ["top"]).collect())) == []


def test_lines_of_a_hot_path(spark, no_broadcast):
    lines = spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 100 < 97, "hot.csv").otherwise(F.concat((F.col("id") % 400).cast("string"), F.lit(".csv"))).alias("path"),
        (F.col("id") + 1).alias("row"), F.concat("id", F.lit(",2")).alias("line"),
    )
    heads = lines.select("path").distinct().select("path", F.lit(0).cast("long").alias("row"), F.lit("a,b").alias("line"))
    rows = line_rows(stage(lines.unionByName(heads), "lines"))
    counts = [c for c in rows_by_task(rows) if c >= 100]
    assert rows.count() == ROWS and max(counts) <= 2 * median(counts)


def profile(spark, first, last):
    return spark.range(first, last).selectExpr(
        "concat('/d/sub-', id % 3, '_tractometry_FA.csv') as path", "concat('sub-', id % 3) as subject", "'ses-1' as session", "'W' as recon_suffix",
        "id + 1 as row", "concat_ws(',', id, id * id % 17, if(id % 5 = 0, 'n/a', string(1e6 + id % 7)), if(id = 4, '1', '')) as line",
    )


def test_moments_merge_to_those_of_the_whole(spark):
    heads = profile(spark, 0, 3).selectExpr("path", "subject", "session", "recon_suffix", "0L as row", "',af_left,cst_right,one' as line")
    whole = heads.unionByName(profile(spark, 0, 400))
    parts = [heads.unionByName(profile(spark, 0, 1)), profile(spark, 1, 150), profile(spark, 150, 151), profile(spark, 151, 400)]
    increments = [rec.node_moments(p) for p in parts]
    merged = rec.merged_moments(increments[0].unionByName(increments[1]).unionByName(increments[2]).unionByName(increments[3]))
    from scalargrid.sources.tables import line_heads

    landed = rec.moment_records(merged, line_heads(heads))
    plain = rec.tractometry_records(line_rows(whole), layout="along_tract")
    streamed = rec.tract_line_records(whole)

    def rows(df):
        return sorted(
            (r["path"], r["bundle"], r["scalar"], None if r["value"] is None else round(r["value"], 7), r["n_nodes"], r["row"], r["column"]) for r in df.collect()
        )

    assert rows(landed) == rows(plain) == rows(streamed) and len(rows(plain)) == 3 * 2 * 2 + 2
    # A row longer than the header spoils its file, also when it lands later.
    long = heads.where("subject = 'sub-1'").selectExpr("path", "subject", "session", "recon_suffix", "999L as row", "'1,2,3,4,5' as line")
    spoiled = rec.tract_line_records(whole.unionByName(long))
    assert {r["subject"] for r in spoiled.collect()} == {"sub-0", "sub-2"}


def test_stored_stages_only_what_is_computed(spark):
    table = stage(spark.range(10).selectExpr("id", "id % 2 as k"), "t")
    assert stored(table.where("k = 1").select("id"), "x").inputFiles() == table.inputFiles()
    assert stored(table.groupBy("k").count(), "x").inputFiles() != table.inputFiles()
