"""Rows that are kept or dropped by decisions: which ones stay, and which ones travel for it."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from scalargrid.llm import common, exact_dedup, near_copies


@pytest.fixture
def no_broadcast(spark):
    """Joins as on tables that are too large for Spark to broadcast by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def shuffled(df) -> int:
    """Bytes that the shuffles of ``df``, when it is collected, take."""
    df.collect()

    def of(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return of(node.executedPlan())
        if name.endswith("QueryStage"):
            return of(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        children = node.children()
        return own + sum(of(children.apply(i)) for i in range(children.size()))

    return of(df._jdf.queryExecution().executedPlan())


def texts(count: int, words: int = 200) -> list[str]:
    random = np.random.default_rng(21)
    return [" ".join(f"w{v}" for v in random.integers(0, 10**6, words)) for _ in range(count)]


def test_rows_that_stay_are_not_shuffled(spark, no_broadcast):
    rows = [(i, t, i % 3) for i, t in enumerate(texts(1000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind long")
    docs = common.stage(docs, "docs")
    mark = F.xxhash64("text").alias("mark")
    decided = common.stage(docs.select("doc_id", mark, (F.col("doc_id") % 50 != 7).alias("kept")), "decided")
    got = common.keep_rows(docs, F.xxhash64("text"), decided)
    assert sorted(map(tuple, got.collect())) == [r for r in rows if r[0] % 50 != 7]
    assert 0 < shuffled(got) < 0.25 * sum(len(t) for _, t, _ in rows)  # 20 texts and false hits


def test_exact_copies_alone_are_shuffled(spark, no_broadcast):
    some = texts(600)
    docs = common.stage(spark.createDataFrame(list(enumerate([*some, *some[:20]])), "doc_id long, text string"), "docs")
    got = exact_dedup.without_copies(docs)
    assert sorted(r.doc_id for r in got.collect()) == list(range(600))
    assert 0 < shuffled(got) < 0.25 * sum(map(len, some))


def test_texts_without_a_near_copy_are_not_shuffled(spark, no_broadcast, monkeypatch):
    some = texts(600)
    changed = some[5].split()
    changed[100] = "changed"
    rows = list(enumerate([*some, " ".join(changed)]))
    docs = common.stage(spark.createDataFrame(rows, "doc_id long, text string"), "docs")
    sizes, connect = [], near_copies.components

    def watched(links):
        sizes.append(shuffled(links))
        return connect(links)

    monkeypatch.setattr(near_copies, "components", watched)
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(docs).collect()}
    assert got == {i: 5 if i == 600 else i for i in range(601)}
    assert len(sizes) == 2 and 0 < sizes[1] < 0.25 * sum(map(len, some))  # the second are links of texts


@pytest.mark.parametrize("full", [False, True])  # bitmaps with nearly every bit set: all rows are false hits
def test_odd_rows_by_thin_and_by_full_bitmaps(spark, no_broadcast, monkeypatch, full):
    if full:
        monkeypatch.setattr(common, "_MAP_BITS", 8)
        monkeypatch.setattr(common, "MOST_BITS", 16)
    rows = [(None, "a", 0), (None, "b", 1), (1, "a", 2), (1, "a", 3), (1, None, 4), (2, None, 5), (3, "c", 6), (4, "d", 7), (5, "e", 8)]
    rows += [(i, f"t{i}", i) for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int")
    own = F.when(F.col("text") != "d", F.xxhash64("text"))  # no mark for NULL and "d"
    made = [(None, "a", False), (None, "b", True), (1, "a", True), (1, "a", True), (3, "a", False), (4, "d", False), (5, "e", False)]
    made += [(i, f"t{i}", i % 2 == 0) for i in range(10, 60)]
    decided = spark.createDataFrame(made, "doc_id long, word string, kept boolean").select("doc_id", F.xxhash64("word").alias("mark"), "kept")
    got = [tuple(r) for r in common.keep_rows(docs, own, common.stage(decided, "decided")).collect()]
    # Of the two rows (1, "a"), which differ only in what nobody compares, one stays.
    assert len([r for r in got if r[:2] == (1, "a")]) == 1
    want = {r for r in rows[:9] if r[2] in (1, 4, 5, 6, 7)} | {r for r in rows[9:] if r[0] % 2 == 0}
    rest = [r for r in got if r[:2] != (1, "a")]
    assert len(rest) == len(want) and set(rest) == want


def test_an_empty_table_and_no_decisions(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    none = common.stage(spark.createDataFrame([], "doc_id long, mark long, kept boolean"), "decided")
    assert common.keep_rows(docs, F.xxhash64("text"), none).count() == 2
    assert common.keep_rows(docs.limit(0), F.xxhash64("text"), none).count() == 0
