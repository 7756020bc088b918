"""Operator 8: toxicity by a bidirectional gated recurrent network over overlapping windows.

A text is a sequence of words: runs of letters and digits, and runs of other marks, lower-cased; only
white space is left out, and a longer run is read in pieces of ``LETTERS`` characters. Every word has
three kinds of inputs: a learned embedding of the hashed word, a learned mean embedding of its
character trigrams (``word_inputs``; trained with the network), and what labelled texts say about the word itself and about its longer
character n-grams (most, mean and least telling one, and those that begin it), with its length.
Windows of ``WINDOW`` words, each ``STRIDE`` after the last, cover the whole text, at the same places
however long it is; the network gives each a logit, and the highest decides, calibrated on labelled documents.

Learned from at most ``FIT_POSITIVE`` + ``FIT_NEGATIVE`` labelled rows outside the held-out fold,
chosen by a hash of the id (documented bounds). Their texts are counted and cut into windows in
tasks. What a word tells is counted on one half of them for windows of the other, so that no
document explains itself. One row in ``CALIBRATED`` is kept for the calibration. One task then trains the network on windows of at most ``WINDOWS_EACH`` per
document and sends its weights to the driver; the driver holds no texts, windows or counts, only
these weights and the compressed evidence (``BUCKETS`` numbers). Scoring covers every text, all of
it, and every window, with memory bounded by ``_CHUNK_WORDS``. Workers first give back token ids that an earlier stage remembers.

Defined results: NULL texts and texts without words have one window of empty words and a score
like any other; labels that are NULL are left out, several labels of one document count as toxic
if any is; without labels of both kinds all scores are the share of toxic ones (0 if none); an
empty table gives no rows; only ``text`` is an input of a score; other columns are not read.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, held_out, stage, table
from scalargrid.llm.encoding import forget
from scalargrid.llm.gru import Gru
from scalargrid.llm.word_inputs import LETTERS, SIZE, WordInputs, codes_of, mixed

WINDOW, STRIDE = 48, 24
FIT_POSITIVE, FIT_NEGATIVE = 4_000, 8_000
WINDOWS_EACH = 3
CALIBRATED = 4  # one row in so many is not trained on
GRAMS = (4, 5, 6)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
GIVEN = 8  # inputs of a word that are not learned
INPUTS = GIVEN + 2 * SIZE
_KEEP_WORDS = 300_000
_CHUNK_WORDS = 8_333 * STRIDE  # windows of a long text stay where they would be without chunks
_WORD = re.compile(rf"[^\W_]{{1,{LETTERS}}}|(?:[^\w\s]|_){{1,{LETTERS}}}")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: bucket of the word, then of each n-gram, with 1 marking both ends; which are real; length."""
    codes, length = codes_of(words)
    width = int(length.max(initial=0)) + 2
    found = [mixed(codes, 0, LETTERS + 2, 99, BUCKET_BITS)]
    real = [np.ones(len(words), bool)]
    for size in GRAMS:
        for first in range(width - size + 1):
            found.append(mixed(codes, first, size, size, BUCKET_BITS))
            real.append(first + size <= length + 2)
    return np.stack(found, axis=1), np.stack(real, axis=1), length


def features(words: list[str], evidence: np.ndarray) -> np.ndarray:
    """Given inputs of words."""
    out = np.zeros((len(words), GIVEN), np.float32)
    for at in range(0, len(words), 20_000):
        place, real, length = buckets(words[at : at + 20_000])
        told = evidence[place]
        grams, own = np.where(real[:, 1:], told[:, 1:], 0), out[at : at + 20_000]
        count = np.maximum(1, real[:, 1:].sum(axis=1))
        own[:, 0] = told[:, 0]
        if grams.shape[1]:
            own[:, 1], own[:, 2], own[:, 3] = grams.max(axis=1), grams.sum(axis=1) / count, grams.min(axis=1)
        column, width = 0, int(length.max(initial=0)) + 2
        for k, size in enumerate(GRAMS):  # the n-gram that begins the word is the first of its size
            if column < grams.shape[1]:
                own[:, 4 + k] = grams[:, column]
            column += max(0, width - size + 1)
        own[:, 7] = length / 12
    return out


def evidence_of(counts: np.ndarray, positive: int, negative: int) -> np.ndarray:
    """Log-odds per bucket from documents of either kind that have it, shrunk where there are few."""
    p, n = counts[:, 0], counts[:, 1]
    odds = np.log((p + 1) / (positive + 2)) - np.log((n + 1) / (negative + 2))
    return (odds * (p + n) / (p + n + 4)).astype(np.float32)


def window_starts(n: int) -> list[int]:
    """Starts of windows that cover ``n`` words; one for a text without words."""
    last = max(0, n - WINDOW)
    return [*range(0, last, STRIDE), last]


def packed(evidence: np.ndarray) -> bytes:
    return zlib.compress(evidence.astype("<f4").tobytes(), 6)


def unpacked(evidence: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(evidence), "<f4")


class Vocabulary(dict):
    """Words to rows of a growing table of inputs; row 0 is the empty word. Without ``learned`` the given inputs only."""

    def __init__(self, evidence: np.ndarray, learned: WordInputs | None = None) -> None:
        self._evidence, self._learned = evidence, learned
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self._rows, self._new = np.zeros((1, INPUTS if self._learned else GIVEN), np.float32), []

    def __missing__(self, word: str) -> int:
        self._new.append(word)
        at = self[word] = len(self._rows) + len(self._new) - 1
        return at

    def indices(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))

    def inputs(self) -> np.ndarray:
        if self._new:
            parts = [features(self._new, self._evidence)]
            if self._learned:
                parts.append(np.concatenate([self._learned.learn(self._new[at : at + 20_000]).vectors() for at in range(0, len(self._new), 20_000)]))
            self._rows = np.concatenate([self._rows, np.concatenate(parts, axis=1)])
            self._new = []
        return self._rows

    def tidy(self) -> None:
        if len(self) > _KEEP_WORDS:
            self._forget()


def windows(indices: np.ndarray) -> np.ndarray:
    """Rows of word indices, padded with the empty word."""
    starts = np.array(window_starts(len(indices)))
    at = starts[:, None] + np.arange(WINDOW)
    padded = np.concatenate([indices, np.zeros(WINDOW, np.int32)])
    return padded[at]


@dataclass
class Model:
    """What scoring needs: packed evidence per bucket, network, learned inputs, and the calibration of its logits."""

    evidence: bytes = b""
    weights: dict[str, np.ndarray] | None = None
    learned: dict[str, np.ndarray] | None = None
    slope: float = 1.0
    shift: float = 0.0
    share: float = 0.0

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        """Highest logit of each text."""
        network, vocabulary = Gru(INPUTS, weights=self.weights), Vocabulary(unpacked(self.evidence), WordInputs(self.learned))

        def flush(parts: list[np.ndarray], owners: list[np.ndarray], best: np.ndarray) -> None:
            rows, owner, table = np.concatenate(parts), np.concatenate(owners), vocabulary.inputs()
            for at in range(0, len(rows), 4096):
                logits = network.forward(table[rows[at : at + 4096].T])
                np.maximum.at(best, owner[at : at + 4096], logits)

        def score(texts: list[str | None]) -> np.ndarray:
            best = np.full(len(texts), -np.inf, np.float32)
            parts, owners, size = [], [], 0
            for i, text in enumerate(texts):
                indices = vocabulary.indices(words_of(text))
                for at in range(0, max(1, len(indices) - STRIDE), _CHUNK_WORDS):  # a long text in overlapping stretches
                    part = windows(indices[at : at + _CHUNK_WORDS + WINDOW - STRIDE])
                    parts.append(part)
                    owners.append(np.full(len(part), i))
                    size += part.size // 2
                    if size >= _CHUNK_WORDS:
                        flush(parts, owners, best)
                        parts, owners, size = [], [], 0
            if parts:
                flush(parts, owners, best)
            vocabulary.tidy()
            return best

        return score

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * logits.astype(np.float64) + self.shift, -40, 40)))


def fit_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Staged ``doc_id, text, toxic, half, aside`` to learn from, and the share of toxic rows outside the held-out fold."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    open_rows = known.where(~held_out())
    share = open_rows.agg(F.avg("toxic")).first()[0] or 0.0
    drawn = F.xxhash64("doc_id")
    chosen = [open_rows.where(F.col("toxic") == k).orderBy(drawn, "doc_id").limit(n) for k, n in ((1, FIT_POSITIVE), (0, FIT_NEGATIVE))]
    ids = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "_id")  # FIT_POSITIVE + FIT_NEGATIVE rows at most
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(2)).cast("int").alias("half"),
        (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(2)), F.lit(CALIBRATED)) == 0).alias("aside"),
    )
    return stage(joined, "toxic-fit"), float(share)


def _evidence(rows: DataFrame) -> list[bytes]:
    """Packed evidence for documents of half 0 and of half 1, each from the other half, and from both; nothing without both kinds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros((4, BUCKETS), np.int32)
        seen = np.zeros(4, np.int64)
        for batch in batches:
            for text, toxic, half in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kind = 2 * half + (0 if toxic else 1)
                seen[kind] += 1
                words = list(set(words_of(text.as_py())))
                if words:
                    place, real, _ = buckets(words)
                    counts[kind, np.unique(place[real])] += 1
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": np.append(used, -1), **{f"n{k}": np.append(counts[k, used], seen[k]).astype(np.int64) for k in range(4)}})

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((4, BUCKETS), np.int64), np.zeros(4, np.int64)
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            for k in range(4):
                n = batch.column(k + 1).to_numpy()
                counts[k, bucket[bucket >= 0]] += n[bucket >= 0]
                totals[k] += n[bucket < 0].sum()
        counts, totals = counts.reshape(2, 2, BUCKETS), totals.reshape(2, 2)
        if totals.sum(axis=0).all():
            of = [(counts[1], totals[1]), (counts[0], totals[0]), (counts.sum(axis=0), totals.sum(axis=0))]
            blobs = [packed(evidence_of(c.T, int(t[0]), int(t[1]))) for c, t in of]
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(3), pa.int32()), "evidence": blobs})

    names = [f"n{k}" for k in range(4)]
    summed = rows.select("text", "toxic", "half").mapInArrow(count, "bucket long, n0 long, n1 long, n2 long, n3 long").groupBy("bucket").agg(
        *(F.sum(n).alias(n) for n in names)
    )
    # What only one or two documents have tells little; at most BUCKETS rows of numbers meet in one task.
    telling = summed.where("bucket < 0 OR n0 + n2 > 1 OR n1 + n3 > 9").repartition(1)
    return [bytes(r["evidence"]) for r in sorted(telling.mapInArrow(told, "place int, evidence binary").collect())]


def _training_windows(rows: DataFrame, told: list[bytes]) -> DataFrame:
    """Staged windows: the most telling one of a toxic document, the two most telling and one more of others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        by_half = [unpacked(t) for t in told]
        for batch in batches:
            out = []
            for doc, text, toxic, half in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = words_of(text)
                vocabulary = Vocabulary(by_half[half])
                rows = windows(vocabulary.indices(words))
                inputs, names = vocabulary.inputs(), ["", *vocabulary]
                telling = np.maximum(inputs[:, 0], inputs[:, 1])[rows].max(axis=1)
                order = np.argsort(-telling, kind="stable")
                chosen = order[:1] if toxic else np.unique(np.append(order[:2], order[len(order) // 2]))
                out += [(doc, int(k), toxic, inputs[rows[k]].astype("<f4").tobytes(), [names[i] for i in rows[k]]) for k in chosen[:WINDOWS_EACH]]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc", "at", "toxic", "inputs", "words"])

    given = rows.select("doc_id", "text", "toxic", "half")
    return stage(given.mapInArrow(cut, "doc long, at int, toxic int, inputs binary, words array<string>"), "toxic-windows")


def _trained(windows: DataFrame) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Weights of the network and of the learned inputs, trained in one task on all windows (their number is bounded)."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        rows = [r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)]
        if not rows:
            return
        rows.sort(key=lambda r: r[:4])
        number: dict[str, int] = {"": 0}
        tokens = np.array([[number.setdefault(w, len(number)) for w in r[4]] for r in rows])
        given = np.frombuffer(b"".join(r[3] for r in rows), "<f4").reshape(len(rows), WINDOW, GIVEN)
        toxic = np.array([r[2] for r in rows], np.float32)
        del rows
        network, learned = Gru(INPUTS), WordInputs().learn(list(number))
        positive = float(toxic.mean())
        network.fit(given, toxic, np.where(toxic > 0, 0.5 / positive, 0.5 / (1 - positive)).astype(np.float32), learned, tokens)
        file = io.BytesIO()
        np.savez_compressed(file, **{f"n_{k}": v for k, v in network.weights.items()}, **{f"l_{k}": v for k, v in learned.weights.items()})
        yield pa.RecordBatch.from_pydict({"weights": [file.getvalue()]})

    blob = windows.repartition(1).mapInArrow(train, "weights binary").first()["weights"]
    stored = dict(np.load(io.BytesIO(bytes(blob))))
    network, learned = ({k[2:]: v for k, v in stored.items() if k[0] == kind} for kind in "nl")
    return network, learned


def _calibrated(rows: DataFrame, told: list[bytes], weights: dict[str, np.ndarray], learned: dict[str, np.ndarray], share: float) -> tuple[float, float]:
    """Slope and shift from documents' highest logits to probabilities, by Newton steps, at the true share of toxic rows."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorers = [Model(t, weights, learned).scorer() for t in told]
        for batch in batches:
            half, texts = np.array(batch.column(2).to_pylist(), dtype=int), batch.column(0).to_pylist()
            best = np.zeros(len(texts))
            for h in (0, 1):
                at = np.flatnonzero(half == h)
                best[at] = scorers[h]([texts[i] for i in at])
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "logit": best})

    # Two numbers for each of the FIT_POSITIVE + FIT_NEGATIVE rows.
    found = rows.select("text", "toxic", "half").mapInArrow(score, "toxic int, logit double").orderBy("toxic", "logit").collect()
    y, x = np.array([r.toxic for r in found], float), np.array([r.logit for r in found])
    weight = np.where(y > 0, share / max(1.0, y.sum()), (1 - share) / max(1.0, (1 - y).sum()))
    slope, shift = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -40, 40)))
        error, bend = weight * (p - y), weight * p * (1 - p) + 1e-12
        grad = np.array([(error * x).sum() + 1e-3 * (slope - 1), error.sum() + 1e-5 * shift])
        curve = np.array([[(bend * x * x).sum() + 1e-3, (bend * x).sum()], [(bend * x).sum(), bend.sum() + 1e-5]])
        move = np.linalg.solve(curve, grad)
        move *= min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
        slope, shift = slope - move[0], shift - move[1]
    return float(max(slope, 1e-3)), float(shift)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    rows, share = fit_rows(docs, labels)
    told = _evidence(rows)
    if not told:
        return Model(share=share)
    aside = rows.where("aside")
    if aside.select("toxic").distinct().count() < 2:  # a handful of labels: trained and calibrated on all
        trained = aside = rows
    else:
        trained = rows.where("NOT aside")
    weights, learned = _trained(_training_windows(trained, told[:2]))
    slope, shift = _calibrated(aside, told[:2], weights, learned, share)
    return Model(told[2], weights, learned, slope, shift, share)


def scored(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns of ``docs`` and ``toxic_score``."""
    kinds = docs.select(*columns).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        score = model.scorer() if model.weights else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            values = model.probability(score(texts)) if score else np.full(len(texts), model.share)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.float64())], names=[*(f"c{i}" for i in range(len(columns))), "s"])

    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kinds)), "s double"])
    given = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col("text").cast("string").alias("_text"))
    return given.mapInArrow(each, schema).toDF(*columns, "toxic_score")


def op8_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted")
    )
