"""Operator 3: language by rank-order profiles of character n-grams.

The ``PROFILE`` most frequent n-grams of 1 to 3 letters (a word's ends count as a sign of their
own) make a language's profile, in order of frequency over all documents it is learned from. A
document's own most frequent n-grams are looked up in each profile: the distance is the sum of how
many places each is out of place, ``PROFILE`` for one that is missing. The nearest language wins.

Learning counts n-grams inside tasks and adds the counts up by language and n-gram; only the
profiles themselves, ``PROFILE`` rows per language, come to the driver. Text is counted in pieces
of ``_STEP`` characters, which changes no count: n-grams across a cut belong to the piece behind it.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and so is
everything if there is nothing to learn from; equal distances go to the first language by name,
equally frequent n-grams to the smaller code points; documents without ``lang`` are predicted but
not learned from; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, held_out

PROFILE = 400
UNDETERMINED = "und"
_STEP = 500_000
_EDGE = 1  # stands for all that is no letter
_BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(text: str, step: int) -> Iterator[np.ndarray]:
    """All n-grams of the lower-cased text, piece by piece; each run of other characters and both ends become one edge."""
    rest = text.lower() + " "
    tail = np.array([_EDGE], dtype=np.int64)  # the last two codes before a piece
    for at in range(0, len(rest), step):
        raw = np.frombuffer(rest[at : at + step].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[raw]
        codes = np.where(letter, raw, _EDGE).astype(np.int64)
        codes = codes[letter | np.concatenate([[tail[-1] != _EDGE], letter[:-1]])]
        if len(codes):
            joined = np.concatenate([tail, codes])
            two = joined[:-1] << _BITS | joined[1:]
            yield np.concatenate([codes[codes != _EDGE], two[len(tail) - 1 :], two[:-1] << _BITS | joined[2:]])
            tail = joined[-2:]


def count_grams(texts: Iterable[str], step: int = _STEP) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of the texts, ascending, and how often they occur."""
    known, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[np.ndarray] = []
    size = 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        if not len(known):
            return new, n
        both, place = np.unique(np.concatenate([known, new]), return_inverse=True)
        return both, np.bincount(place, np.concatenate([counts, n])).astype(np.int64)

    for text in texts:
        for grams in _grams(text, step):
            waiting.append(grams)
            size += len(grams)
            if size >= step:
                known, counts = added()
                waiting, size = [], 0
    return added() if waiting else (known, counts)


def most_frequent(known: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    return known[np.argsort(-counts, kind="stable")[:size]]


def profiles(learned: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """n-grams by rank for every language of ``learned`` (``text``, ``lang``)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, texts: list[str]) -> None:
            known, counts = count_grams(texts)
            if lang in sums:
                both, place = np.unique(np.concatenate([sums[lang][0], known]), return_inverse=True)
                sums[lang] = both, np.bincount(place, np.concatenate([sums[lang][1], counts])).astype(np.int64)
            else:
                sums[lang] = known, counts

        waiting, sizes = defaultdict(list), defaultdict(int)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                waiting[lang].append(text.as_py())
                sizes[lang] += len(waiting[lang][-1])
                if sizes[lang] > _STEP:
                    add(lang, waiting.pop(lang))
                    del sizes[lang]
        for lang, texts in waiting.items():
            add(lang, texts)
        for lang, (known, counts) in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(known), pa.string()), "gram": known, "n": counts})

    counted = learned.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).mapInArrow(partial, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order))
    found: dict[str, list[int]] = defaultdict(list)
    for lang, gram in ranked.where(F.col("rank") <= size).orderBy("lang", "rank").select("lang", "gram").collect():
        found[lang].append(gram)
    return dict(found)


class Ranks:
    """All profiles side by side: for a known n-gram its rank in each language, else ``size``."""

    def __init__(self, found: dict[str, list[int]], size: int = PROFILE) -> None:
        self.names, self.size = sorted(found), size
        self.known = np.array(sorted({g for grams in found.values() for g in grams}), dtype=np.int64)
        # One column more, for n-grams that no profile has.
        self.ranks = np.full((len(self.names), len(self.known) + 1), size, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.known, np.array(found[name], dtype=np.int64))] = np.arange(len(found[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        top = most_frequent(*count_grams([text or ""]), self.size)
        if not len(top) or not self.names:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.known, top)
        at[self.known[np.minimum(at, len(self.known) - 1)] != top] = len(self.known)
        places = self.ranks[:, at]
        moved = np.where(places < self.size, np.abs(places - np.arange(len(top))), self.size)
        distance = moved.sum(axis=1)
        best = int(distance.argmin())
        return self.names[best], 1.0 - float(distance[best]) / (self.size * len(top))


def predicted(docs: DataFrame, found: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; only ``text`` is an input of the prediction."""
    ranks = Ranks(found, size)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [ranks.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    ).mapInArrow(each, "doc_id long, held_out boolean, lang_pred string, score double")


def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predicted(docs, profiles(docs.where(~held_out())))
