"""The exact-copy stage against a plain program, and which texts it hashes."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from scalargrid.llm import exact_dedup


def _plain(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def test_one_row_of_each_group_stays(spark):
    random = np.random.default_rng(5)
    prefix = "p" * exact_dedup.PREFIX_CHARS
    texts = [None, "", " \n", "a b", "ab", "a b", *(f"{prefix}{i}" for i in range(20)), *(f"word {i}" for i in range(60))]
    rows = []
    for i in range(600):
        text = texts[random.integers(0, len(texts))] if i % 3 else "a  third of all"
        spaced = text if text is None else text.replace("a", "a" + " " * int(random.integers(0, 3)))
        rows.append((None if i % 50 == 0 else i // 2, spaced, i, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, plain int, own string").repartition(4)
    best: dict[str, tuple] = {}
    for doc_id, text, *_ in rows:
        rank = (-len(text or ""), doc_id is not None, doc_id or 0)
        best[_plain(text)] = min(best.get(_plain(text), rank), rank)
    got = exact_dedup.without_copies(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    assert {_plain(r.text): (-len(r.text or ""), r.doc_id is not None, r.doc_id or 0) for r in kept} == best
    assert len(kept) == len(best) and {tuple(r) for r in kept} <= set(rows)


def test_only_texts_that_may_have_a_copy_are_hashed(spark):
    texts = [f"text number {i} of its own" + "x" * i for i in range(300)] + ["one text twice"] * 2 + ["q" * 200 + "1", "q" * 200 + "2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashed = {r.doc_id for r in exact_dedup.hashed(docs).where(F.col("full").isNotNull()).collect()}
    assert {300, 301, 302, 303} <= hashed and len(hashed) < 8
    assert exact_dedup.without_copies(docs).count() == 303
