"""Operator 12: licence scans by a positional index of rare words.

``TEMPLATES`` are licence notices: a label, the notice's words, and the key phrases that must be in it.
The index has, for every key phrase, the positions of its ``LOOKUPS`` rarest words; how rare a licence word is
(its IDF) is counted over all documents. A file is scanned once:

1. its licence words that the index knows are taken with their positions, rarest words of each phrase only,
   so ordinary words such as "the" are never looked up;
2. position in the file minus position in the phrase is where the phrase would start; starts on which the rarest
   words agree are intersected, and the whole phrase is compared there;
3. a notice is found if its key phrases stand where the notice has them, up to ``SLACK`` words
   inserted or lost: their own starts minus their positions in the notice fall into the same or the next
   of steps of ``SLACK`` words.

*Base* templates consist of their phrase alone, so every place of it is found. The others add labels. ``score``
is 1 for a base phrase. A found notice has half, and as much of the other half as its words, weighed by
IDF, occur around it; a notice with only some of its key phrases has that share of a half. The best of a file counts.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. Everything is columns of one
row, so nothing but the counts of the licence words is shuffled; these come to the driver, at most one for each word of ``TEMPLATES``.

Defined results: NULL and empty texts have no words, no labels and score 0; rows that repeat a
``doc_id`` each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import documents
from scalargrid.runtime import computed_once

LOOKUPS = 2
SLACK = 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of texts whose A-Z are not lower-cased yet


@dataclass(frozen=True)
class Template:
    label: str
    notice: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]  # position in the notice, words
    base: bool = False


def template(label: str, notice: str, *keys: str, base: bool = False) -> Template:
    """A notice whose key phrases, given as text, occur in it; without any, the notice is its own key phrase."""
    words = tuple(notice.split())

    def place(key: tuple[str, ...]) -> int:
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)

    phrases = [tuple(k.split()) for k in keys] or [words]
    return Template(label, words, tuple((place(p), p) for p in phrases), base)


# Wording of public licence notices.
TEMPLATES = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
    template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        "permission is hereby granted free of charge", "to deal in the software without restriction",
    ),
    template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may not use this file except in compliance with the license", "www apache org licenses license 2 0",
    ),
    template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice",
        "redistributions of source code must retain", "redistributions in binary form must reproduce",
    ),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "permission to use copy modify and", "for any purpose with or without fee is hereby granted"),
    template("gpl", "under the terms of the gnu general public license as published by the free software foundation",
             "gnu general public license", "published by the free software foundation"),
    template("gpl-2", "gnu general public license version 2"),
    template("gpl-3", "gnu general public license version 3"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software", "released into the public domain"),
    template("cc0", "creative commons cc0 1 0 universal", "cc0 1 0 universal"),
    template("cc-by", "creative commons attribution 4 0 international", "creative commons attribution 4 0"),
    template("cc-by-sa", "cc by sa"),
    template("cc-by-sa", "creative commons attribution sharealike"),
    template("cc-by-nd", "creative commons attribution noderivatives"),
    template("cc-by-nc", "creative commons attribution noncommercial"),
    template("mit", "spdx license identifier mit"),
    template("apache-2", "spdx license identifier apache 2 0"),
    template("gpl-2", "spdx license identifier gpl 2 0"),
    template("gpl-3", "spdx license identifier gpl 3 0"),
    template("bsd", "spdx license identifier bsd 3 clause"),
    template("bsd", "spdx license identifier bsd 2 clause"),
)


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    return sorted({w for t in templates for w in t.notice})


def _lower(word: Column) -> Column:
    """A-Z only, as lower-casing of other letters could make ASCII ones."""
    return F.translate(word, _UPPER, _UPPER.lower())


def _words(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), _APART)


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """IDF of every licence word over all documents: ln(1 + documents / (1 + documents that have it))."""
    known = F.array(*map(F.lit, vocabulary(templates)))
    has = docs.select(F.explode(F.concat(F.array_intersect(_words(_lower(F.col("text"))), known), F.array(F.lit(""))).alias("word")).alias("word"))
    counts = {r["word"]: r["count"] for r in has.groupBy("word").count().collect()}  # "" counts all documents
    return {w: math.log(1 + counts.get("", 0) / (1 + counts.get(w, 0))) for w in vocabulary(templates)}


def index(phrases: list[tuple[str, ...]], idf: dict[str, float]) -> list[list[tuple[str, int]]]:
    """Per phrase its rarest words and their first positions, rarest first."""
    rarest = [sorted(set(p), key=lambda w: (-idf[w], w))[:LOOKUPS] for p in phrases]
    return [[(w, p.index(w)) for w in words] for words, p in zip(rarest, phrases, strict=True)]


def _places(words: Column, seen: Column, phrase: tuple[str, ...], postings: list[tuple[str, int]]) -> Column:
    """Starts of a phrase: those on which its rarest words agree and where all its words stand."""

    def starts(word: str, at: int) -> Column:
        return F.transform(F.filter(seen, lambda s: s["word"] == word), lambda s: s["at"] - at)

    agreed = reduce(F.array_intersect, (starts(*p) for p in postings))
    whole = F.array(*map(F.lit, phrase))
    return F.filter(agreed, lambda s: (s >= 0) & (F.transform(F.slice(words, F.greatest(s, F.lit(0)) + 1, len(phrase)), _lower) == whole))


def _found(places: list[Column], t: Template) -> Column:
    """Steps of ``SLACK`` words at which a notice begins, by all its key phrases."""

    def steps(k: int) -> Column:
        return F.transform(places[k], lambda p: F.floor((p - t.keys[k][0]) / SLACK).cast("int"))

    both = F.array_distinct(steps(0))
    for k in range(1, len(t.keys)):
        near = F.flatten(F.transform(steps(k), lambda s: F.array(s - 1, s, s + 1)))
        both = F.array_intersect(both, near)
    return both


def _coverage(words: Column, step: Column, t: Template, idf: dict[str, float]) -> Column:
    """Share of the notice's words, by IDF, that occur around a place."""
    unique = sorted(set(t.notice))
    around = F.slice(words, F.greatest(step * SLACK, F.lit(0)) + 1, len(t.notice) + 2 * SLACK)
    there = F.array_intersect(F.transform(around, _lower), F.array(*map(F.lit, unique)))
    weights = F.create_map(*(F.lit(x) for w in unique for x in (w, idf[w])))
    return F.aggregate(there, F.lit(0.0), lambda total, w: total + F.coalesce(weights[w], F.lit(0.0))) / sum(idf[w] for w in unique)


def licences(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, found, score`` per row; ``found`` has a struct of ``label``, ``base`` and ``places`` for each notice that is there.

    ``places`` are word numbers: of a base phrase all its places, of other notices those of its first key phrase.
    """
    idf = rarity(docs, templates)
    phrases = sorted({k for t in templates for _, k in t.keys})
    postings = index(phrases, idf)
    looked_up = sorted({w for p in postings for w, _ in p})
    empty = F.array().cast("array<int>")

    split = computed_once(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")), [_words(F.col("text")).alias("_split")])
    lead, tail = (F.element_at("_split", i) == "" for i in (1, -1))
    # Only the first and the last piece can be empty; a text without words is one empty piece or two.
    size = F.size("_split") - lead.cast("int") - F.when(F.size("_split") > 1, tail.cast("int")).otherwise(0)
    words = computed_once(split.drop("text"), [F.slice("_split", lead.cast("int") + 1, F.greatest(size, F.lit(0))).alias("_words")]).drop("_split")
    numbered = F.transform("_words", lambda w, i: F.struct(F.lower(w).alias("word"), i.alias("at")))
    seen = computed_once(words, [F.filter(numbered, lambda s: s["word"].isin(looked_up)).alias("_seen")])
    every = F.array(*(_places(F.col("_words"), F.col("_seen"), p, q) for p, q in zip(phrases, postings, strict=True)))
    none = F.array(*[empty] * len(phrases))
    placed = computed_once(seen, [F.when(F.size("_seen") > 0, every).otherwise(none).alias("_places")])

    at = {p: F.col("_places")[i] for i, p in enumerate(phrases)}
    any_there = F.exists("_places", lambda p: F.size(p) > 0)
    steps = [F.when(any_there, _found([at[k] for _, k in t.keys], t)).otherwise(empty) for t in templates]
    stepped = computed_once(placed, [F.array(*steps).alias("_steps")])
    hits, scores = [], []
    for i, t in enumerate(templates):
        here, first = F.size(F.col("_steps")[i]) > 0, at[t.keys[0][1]]
        hits.append(F.when(here, F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), first.alias("places"))))
        share = reduce(lambda a, b: a + b, (F.when(F.size(at[k]) > 0, 1.0).otherwise(0.0) for _, k in t.keys)) / (2 * len(t.keys))
        full = F.lit(1.0) if t.base else 0.5 + 0.5 * _coverage(F.col("_words"), F.array_min(F.col("_steps")[i]), t, idf)
        scores.append(F.when(here, full).otherwise(F.lit(0.0) if t.base else share))
    some = F.exists("_places", lambda p: F.size(p) > 0)
    nothing = F.array().cast("array<struct<label:string,base:boolean,places:array<int>>>")
    return stepped.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        F.when(some, F.filter(F.array(*hits), lambda h: h.isNotNull())).otherwise(nothing).alias("found"),
        F.when(some, F.least(F.greatest(*scores), F.lit(1.0))).otherwise(0.0).alias("score"),
    )


def op12_rare_word_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences(documents(spark, sf_dir))
    base = F.filter("found", lambda f: f["base"])
    every = F.flatten(F.transform(base, lambda f: f["places"]))

    def joined(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda f: f["label"]))), ",")

    return computed_once(found, [every.alias("_base")]).select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
        F.array_min("_base").cast("long").alias("first_word"), F.array_max("_base").cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"), F.round("score", 6).alias("score"),
    )


def _sql() -> str:
    """The same rows by plain search of every phrase at every word."""
    phrases = sorted({k for t in TEMPLATES for _, k in t.keys})
    name = {p: f"p{i}" for i, p in enumerate(phrases)}
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    places = ",\n".join(
        f"list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] = '{p[0]}' AND w[i:i + {len(p) - 1}] = {listed(p)}), lambda i: i - 1) AS {name[p]}"
        for p in phrases
    )
    steps, hits, scores = [], [], []
    for i, t in enumerate(TEMPLATES):
        step = [f"list_transform({name[k]}, lambda p: CAST(floor((p - {at}) / {SLACK}.0) AS BIGINT))" for at, k in t.keys]
        near = [f"len(list_filter({s}, lambda o: abs(o - s) <= 1)) > 0" for s in step[1:]]
        steps.append(f"list_filter({step[0]}, lambda s: {' AND '.join(near) or 'true'}) AS s{i}")
        hits.append(f"CASE WHEN len(s{i}) > 0 THEN '{t.label}' END")
        unique = sorted(set(t.notice))
        share = " + ".join(f"CASE WHEN len({name[k]}) > 0 THEN 1.0 ELSE 0.0 END" for _, k in t.keys)
        weight = f"list_sum(list_transform({listed(unique)}, lambda v: CASE WHEN list_contains(%s, v) THEN idf[v] ELSE 0.0 END))"
        around = f"w[greatest(list_min(s{i}) * {SLACK}, 0) + 1 : greatest(list_min(s{i}) * {SLACK}, 0) + {len(t.notice) + 2 * SLACK}]"
        full = f"0.5 + 0.5 * {weight % around} / {weight % listed(unique)}"
        scores.append("CASE WHEN len(s{0}) > 0 THEN {1} ELSE {2} END".format(i, "1.0" if t.base else full, "0.0" if t.base else f"({share}) / {2 * len(t.keys)}"))
    base = [(i, t) for i, t in enumerate(TEMPLATES) if t.base]
    every = "flatten([" + ", ".join(name[t.keys[0][1]] for _, t in base) + "])"
    labels = lambda x: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(x)}], lambda l: l IS NOT NULL))), ','), '')"
    return rf"""
WITH cut AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), has AS (
    SELECT word, count(DISTINCT r) AS n FROM (SELECT r, unnest(w) AS word FROM cut)
    WHERE word IN ({", ".join(f"'{w}'" for w in vocabulary())}) GROUP BY word
), idf AS (
    SELECT map_from_entries(list((v.word, ln(1.0 + (SELECT count(*) FROM cut) / (1.0 + coalesce(n, 0)))))) AS idf
    FROM (SELECT unnest({listed(vocabulary())}) AS word) v LEFT JOIN has ON v.word = has.word
), placed AS (
    SELECT doc_id, w, idf, {places} FROM cut, idf
), stepped AS (
    SELECT *, {every} AS every_base, {", ".join(steps)} FROM placed
)
SELECT doc_id, len(w) AS n_words, len(every_base) AS n_base, list_min(every_base) AS first_word, list_max(every_base) AS last_word,
       {labels([hits[i] for i, _ in base])} AS base_labels, {labels(hits)} AS labels,
       round(least(greatest({", ".join(scores)}), 1.0), 6) AS score
FROM stepped
"""


ORACLE_SQL = _sql()
