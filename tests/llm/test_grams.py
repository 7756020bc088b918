"""Rank-order profiles against plain counting, whatever pieces a text is counted in."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scalargrid.llm.language import PROFILE, count_grams, predicted, profiles

EDGE = "\x01"


def grams(text: str) -> Counter:
    """n-grams as strings; what is no letter is an edge."""
    line = "".join(c if c.isalpha() else EDGE for c in f" {text.lower()} ")
    line = re.sub(f"{EDGE}+", EDGE, line)
    found = Counter(c for c in line if c != EDGE)
    for n in (2, 3):
        found.update(line[i : i + n] for i in range(len(line) - n + 1))
    return found


def code(gram: str) -> int:
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def counted(text: str, step: int) -> dict[int, int]:
    return dict(zip(*(a.tolist() for a in count_grams([text], step)), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abΣéİß .1\n😀", max_size=60), st.integers(1, 20))
def test_cuts_change_no_count(text, step):
    expected = {code(g): n for g, n in grams(text).items()}
    assert counted(text, step) == expected == counted(text, 10**6)


def test_long_texts_are_counted_whole():
    text = "ab cde" * 200_000  # beyond a piece, and no cut falls on an edge of words alone
    assert counted(text, 500_000) == {code(g): n for g, n in grams(text).items()}


def top(counts: Counter) -> list[str]:
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:PROFILE]


@pytest.mark.parametrize("split", [1, 4])
def test_query_against_plain_program(spark, split):
    rng = np.random.default_rng(3)
    letters = {"en": "etaoinshr", "de": "enisratdü", "fr": "esaitnéou"}
    docs = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        words = ["".join(rng.choice(list(letters[lang]), rng.integers(1, 8))) for _ in range(rng.integers(1, 60))]
        docs.append((i, " ".join(words), None if i % 10 == 0 else lang))
    docs += [(900, None, "en"), (901, "", "de"), (902, "12 !?", None), (903, docs[7][1], None), (None, docs[8][1], "de")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(split)
    fold = lambda d: d is not None and crc32(str(d).encode()) % 5 == 0
    sums = defaultdict(Counter)
    for doc_id, text, lang in docs:
        if text is not None and lang is not None and not fold(doc_id):
            sums[lang].update(grams(text))
    ranks = {lang: {g: r for r, g in enumerate(top(c))} for lang, c in sums.items()}
    expected = []
    for doc_id, text, _ in docs:
        own = top(grams(text or ""))
        if not any(c.isalpha() for c in text or ""):
            expected.append((doc_id, fold(doc_id), "und", 0.0))
            continue
        away = {
            lang: sum(abs(known[g] - r) if g in known else PROFILE for r, g in enumerate(own)) for lang, known in ranks.items()
        }
        best = min(sorted(away), key=away.get)
        expected.append((doc_id, fold(doc_id), best, round(1 - away[best] / (PROFILE * len(own)), 12)))
    learned = [i for i, (d, *_) in enumerate(docs) if not fold(d)]
    found = profiles(spark.createDataFrame([docs[i] for i in learned], "doc_id long, text string, lang string"))
    rows = predicted(frame, found).collect()
    assert sorted(map(str, [(r[0], r[1], r[2], round(r[3], 12)) for r in rows])) == sorted(map(str, expected))
