"""Licence scans against a plain search in DuckDB and in Python, on given, planted and odd documents."""

from __future__ import annotations

import re

import duckdb
import pytest

from compare import compare, connect
from llm_rows import EDGE, odd_rows
from scalargrid.llm import licenses
from scalargrid.llm.licenses import TEMPLATES, op12_rare_word_licences

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
MIT, BSD = (next(" ".join(t.notice) for t in TEMPLATES if t.label == label and len(t.notice) > 20) for label in ("mit", "bsd"))
FILLER = "der hund mit der katze under the table by the license office "
PLANTED = [
    "Released under the MIT License.", "UNDER\nTHE\tMIT---LICENSE", "underthe mit license", "under the mit licensee", "under the mit",
    "Licensed under the Apache License, Version 2.0 (the License)", "(CC-BY-NC 4.0), cc by nc; CC BY  NC", "cc by nc cc by nc", "the mit license " * 3,
    MIT.capitalize(), "x " * 999 + MIT + " y" * 999, MIT.replace("any person", "each and every natural person"), MIT.replace("without restriction", "with restriction"),
    BSD, BSD.replace("this list of conditions", "this list of all of these many conditions"), BSD.split("redistributions in")[0],
    "redistributions in binary form must reproduce " + "gap " * 200 + "redistributions of source code must retain",
    "gnu general public license, version 3", "SPDX-License-Identifier: Apache-2.0", "é" + "under the mit license", "K under the mit license K",
    "released into the public domain", FILLER * 400, FILLER * 400 + "under the mit license " * 500, "mit " * 30_000, "cc by " * 9_000 + "nc", "\x00under\x00the\x00mit\x00license\x00", "1 2 3", "...",
]


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("licences"))
    rows = [(i, t, "en", 3, "w") for i, t in enumerate(PLANTED)] + [(0, PLANTED[0], "en", 3, "w"), (None, BSD, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, _words string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_planted_documents(spark, planted):
    rows = op12_rare_word_licences(spark, planted).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert odd_rows(r["doc_id"] for r in rows) == odd_rows([*range(len(PLANTED)), 0, None])
    for i, text in enumerate(PLANTED):
        r = by_id[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(text), i
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
    labels = [by_id[i]["labels"] for i in range(len(PLANTED))]
    assert labels[9] == labels[10] == labels[11] == "mit" and labels[12] == ""
    assert labels[13] == labels[14] == by_id[None]["labels"] == "bsd" and labels[15] == labels[16] == ""
    assert labels[17] == "gpl-3" and labels[18] == "apache-2"
    scores = [by_id[i]["score"] for i in range(len(PLANTED))]
    assert scores[9] == scores[0] == 1.0 and 0.9 < scores[11] < 1.0 and scores[12] == scores[15] == 0.25 and scores[27] == 0.0


def test_sql_on_planted_and_given_documents(spark, planted):
    for folder in (planted, "/root/testdata/sf0.001"):
        if folder == planted:
            duck = duckdb.connect()
            duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet' WHERE length(text) < 30000")
            frame = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 30000")
            frame.write.mode("overwrite").parquet(f"{folder}/short/documents.parquet")
            folder = f"{folder}/short"
        else:
            duck = connect(folder)
        assert compare(op12_rare_word_licences(spark, folder), duck, licenses.ORACLE_SQL) is None


def test_every_given_document(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_rare_word_licences(spark, folder).collect()
    assert len(rows) == len(texts) and any(r["n_base"] for r in rows)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(texts[r["doc_id"]])


def test_odd_and_empty(spark, edge_dir, empty_dir):
    rows = op12_rare_word_licences(spark, edge_dir).collect()
    assert odd_rows(r["doc_id"] for r in rows) == odd_rows(r[0] for r in EDGE)
    assert all((r["n_base"], r["labels"], r["score"], r["first_word"]) == (0, "", 0.0, None) for r in rows)
    assert op12_rare_word_licences(spark, empty_dir).count() == 0


def test_lookups_are_the_rarest_words():
    idf = {w: 1.0 for w in licenses.vocabulary()} | {"mit": 9.0, "license": 5.0, "under": 0.1}
    assert licenses.index([("under", "the", "mit", "license")], idf) == [[("mit", 2), ("license", 3)]]


def test_key_phrases_occur_in_their_notices():
    for t in TEMPLATES:
        for at, words in t.keys:
            assert t.notice[at : at + len(words)] == words
