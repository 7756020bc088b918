"""Operator 13: periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a maximal stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, MIN_REPEATS * q)`` words. Finding all of them:

* **Splitting.** Every word of a run occurs ``MIN_REPEATS`` times in it. So a word that occurs less
  often within its segment is in no run, and splits the segment there; pieces shorter than
  ``MIN_WORDS`` go. Pieces are counted anew, until none changes.
* **Lag scan.** In a segment that is left, a run of period q is a streak of at least
  ``need = max(MIN_WORDS - q, (MIN_REPEATS - 1) * q)`` places whose words equal the words q later.
  Such a streak holds ``CHECKS`` places in a row of any grid of step ``need // CHECKS``, so each
  lag is first tested on its grid only: over all lags of a segment of L words about L log L tests,
  not L squared. Where enough grid places agree in a row, the streak is followed to both ends.
* **Smallest period.** Lags go up. A streak with the ends of a known run only repeats its period.
  Inside a long run, lags that are multiples of its period are not followed again.

All of it is per document, so nothing is shuffled; a worker holds ``CHUNK_WORDS`` words or one document.

Defined results: words are what ``[^\\x20\\x09-\\x0D]+`` finds; NULL, empty and blank texts have no
words, no runs and an empty collapsed text; rows that repeat a ``doc_id`` each get a row; a NULL
``doc_id`` stays NULL, and the query leaves its words as they are; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import documents

MIN_WORDS = 24
MIN_REPEATS = 3
CHECKS = 4
CHUNK_WORDS = 200_000
_TESTS = 1 << 19  # grid places tested at once
_LONG = 1024  # words of a run whose multiples of the period are skipped
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_by_frequency(codes: np.ndarray, segment: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int]]:
    """``(first place, end)`` of the segments that are left; ``segment`` numbers what is consecutive at the start."""
    place, done = np.arange(len(codes)), []
    kinds = int(codes.max()) + 1 if len(codes) else 1
    while len(place):
        _, word, counts = np.unique(segment * kinds + codes[place], return_inverse=True, return_counts=True)
        rare = counts[word] < min_repeats
        split = np.zeros(int(segment[-1]) + 1, dtype=bool)
        split[segment[rare]] = True
        changed = split[segment]
        # A segment that no word splits is stable; the others go on without their rare words.
        for kept, stable in ((~changed, True), (changed & ~rare, False)):
            at, own = place[kept], segment[kept]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(own) != 0)
            number = np.cumsum(new) - 1
            long = np.bincount(number)[number] >= min_words if len(at) else np.zeros(0, dtype=bool)
            if stable:
                first = np.flatnonzero(new & long)
                ends = np.append(np.flatnonzero(new), len(at))
                done += [(int(at[i]), int(at[ends[np.searchsorted(ends, i, "right")] - 1]) + 1) for i in first]
            else:
                rest, left = at[long], number[long]
        place, segment = rest, np.unique(left, return_inverse=True)[1] if len(left) else left
    return sorted(done)


def _streak(codes: np.ndarray, lag: int, place: int) -> tuple[int, int]:
    """Ends of the stretch of places around ``place`` whose words equal the words ``lag`` later."""
    first, end, last, size = place, place + 1, len(codes) - lag, 32
    while end < last:
        stop = min(last, end + size)
        other = codes[end:stop] != codes[end + lag : stop + lag]
        if other.any():
            end += int(other.argmax())
            break
        end, size = stop, size * 2
    size = 32
    while first > 0:
        stop = max(0, first - size)
        other = codes[stop:first] != codes[stop + lag : first + lag]
        if other.any():
            first -= int(other[::-1].argmax())
            break
        first, size = stop, size * 2
    return first, end


def _suspects(codes: np.ndarray, min_words: int, min_repeats: int) -> Iterator[tuple[int, int, int, int]]:
    """``lag, step, first, last``: grid places in a row, ``CHECKS`` or more, that agree at this lag; lags go up."""
    lags = np.arange(1, len(codes) // min_repeats + 1)
    steps = np.maximum(1, np.maximum(min_words - lags, (min_repeats - 1) * lags) // CHECKS)
    sizes = -(-(len(codes) - lags) // steps) + 1  # one more, which parts the lags
    at, bounds = 0, np.cumsum(sizes)
    while at < len(lags):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] - sizes[at] + _TESTS, "right")))
        lag, step, size = lags[at:end], steps[at:end], sizes[at:end]
        starts = np.cumsum(size) - size
        own = np.repeat(np.arange(len(lag)), size)
        place = (np.arange(len(own)) - starts[own] - 1) * step[own]
        same = codes[np.maximum(place, 0)] == codes[np.maximum(place, 0) + lag[own]]
        same[starts] = False
        breaks = np.append(np.flatnonzero(~same), len(own))
        for i in np.flatnonzero(np.diff(breaks) > CHECKS):
            k = own[breaks[i] + 1]
            yield int(lag[k]), int(step[k]), int(place[breaks[i] + 1]), int(place[breaks[i + 1] - 1])
        at = end


def lag_scan(codes: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of one segment, by start and period."""
    runs: dict[tuple[int, int], int] = {}
    long: list[tuple[int, int, int]] = []
    for lag, step, first, last in _suspects(codes, min_words, min_repeats):
        place = first
        while place <= last:
            end = max((e - lag for s, e, p in long if lag % p == 0 and s <= place < e - lag), default=0)
            if not end:
                start, end = _streak(codes, lag, place)
                if end + lag - start >= max(min_words, min_repeats * lag) and (start, end + lag) not in runs:
                    runs[start, end + lag] = lag
                    if end + lag - start >= _LONG:
                        long.append((start, end + lag, lag))
            place += -(-(max(end, place + 1) - place) // step) * step
    return sorted((s, e - s, p) for (s, e), p in runs.items())


def periodic_runs(docs: DataFrame, order: Callable[[int | None, int], np.ndarray | None] | None = None,
                  min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` are structs of ``start``, ``length`` and ``period``, by start and period. ``collapsed`` is
    the text without the words that a run holds after its first period, joined by one space.
    ``order(doc_id, n)`` may give the places from which the n words of a text are taken first.
    """

    def chunks(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, list[bytes], np.ndarray | None]]]:
        held, size = [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            words = (text.as_py() or b"").split()  # of bytes: ASCII white space only
            held.append((doc_id.as_py(), words, order(doc_id.as_py(), len(words)) if order and words else None))
            size += len(words)
            if size >= CHUNK_WORDS:
                yield held
                held, size = [], 0
        yield held

    def found(chunk: list[tuple[int | None, list[bytes], np.ndarray | None]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        parts = []
        for _, words, taken in chunk:
            codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
            parts.append(codes if taken is None else codes[taken])
        del known
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        bounds, codes = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([np.empty(0, np.int64), *parts])
        runs: list[list[dict[str, int]]] = [[] for _ in chunk]
        keep = np.ones(len(codes), dtype=bool)
        for first, end in split_by_frequency(codes, np.repeat(np.arange(len(chunk)), sizes), min_words, min_repeats):
            own = int(np.searchsorted(bounds, first, "right")) - 1
            for start, length, period in lag_scan(codes[first:end], min_words, min_repeats):
                runs[own].append({"start": first + start - int(bounds[own]), "length": length, "period": period})
                keep[first + start + period : first + start + length] = False
        texts = []
        for i, (_, words, taken) in enumerate(chunk):
            words = words if taken is None else [words[j] for j in taken]
            texts.append(b" ".join(compress(words, keep[bounds[i] : bounds[i + 1]].tolist()) if runs[i] else words))
        return pa.RecordBatch.from_arrays(
            [pa.array([c[0] for c in chunk], pa.int64()), pa.array(sizes), pa.array(runs, pa.list_(RUN)), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch):
                yield found(chunk)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        each, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, exactly; then of the smallest start, then period. NULL without runs."""

    def compared(a: Column, b: Column) -> Column:
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        nearer = F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])
        return F.when(more > less, -1).when(more < less, 1).when(nearer, -1).otherwise(1)

    return F.try_element_at(F.array_sort(runs, compared), F.lit(1))


def repeated_places(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places from which the query takes words: a tenth of the documents ends in a repeated passage."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), repeated_places)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat_ws("", F.transform(listed, lambda r: F.concat(r, F.lit("\n"))))
    best = found.select("*", strongest(F.col("runs")).alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )
