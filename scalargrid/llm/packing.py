"""Operator 6: vector best-fit packing of documents into sequences.

Every document is tokenised and gets an end id. A longer one than a sequence is cut into whole
sequences from its end, so that only the first piece may be shorter. Whole pieces are sequences
of their own (with negative numbers) and are not shuffled. The other pieces are dealt into groups of about ``GROUP_PIECES`` by a hash of the
document, and each group is packed longest piece first: every open sequence that can take the
piece under *all* capacities (tokens, documents, attention cost) is scored by the norm of what
would be left in it, each capacity as a share and weighted, and the smallest is taken. A group
leaves at most a few sequences partly empty.

Only lengths and checksums are shuffled, never texts or ids.

Defined results: NULL texts are empty and have only the end id; rows that repeat a ``doc_id``
are packed each on its own; an empty table gives no rows; other columns are ignored; ties in
score go to the sequence opened first, ties in length to the smaller ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, stage
from scalargrid.llm.encoding import KEEP_CHUNKS, encoder, give_back

MAX_TOKENS = 2048
MAX_DOCUMENTS = 2048
MAX_COST = MAX_TOKENS**2  # of attention: the sum of squared piece lengths
WEIGHTS = (1.0, 0.05, 0.05)  # of the shares of tokens, documents and cost left
GROUP_PIECES = 16_384
END_ID = 0
_PIECE = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int = END_ID, limit: int = MAX_TOKENS, keep: int = KEEP_CHUNKS
) -> DataFrame:
    """One row per piece; ``copy`` tells rows apart that repeat a ``doc_id``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, True, keep).encode
        for batch in batches:
            give_back()
            out: list[tuple] = []
            for doc, copy, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = memoryview(encode(text.as_py() or "") + end)
                total = len(raw) // 4
                first = total % limit or limit
                bounds = [0, *range(first, total + 1, limit)]
                out += [
                    (doc, copy, k, a, b - a, crc32(raw[4 * a : 4 * b]))
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                ]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "copy", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("copy"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(cut, _PIECE)


def best_fit(
    lengths: np.ndarray, max_tokens: int = MAX_TOKENS, max_documents: int = MAX_DOCUMENTS,
    max_cost: int = MAX_COST, weights: tuple[float, float, float] = WEIGHTS,
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the given order. A piece too costly for any bin gets its own."""
    caps = np.array([max_tokens, max_documents, max_cost], dtype=np.float64)
    scale = np.sqrt(np.array(weights)) / caps
    left = np.empty((3, 1024))
    names = np.empty(1024, dtype=np.int64)
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    used: list[int] = []
    active = 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) * length])
        at = -1
        if active:
            after = left[:, :active] - need[:, None]
            fits = (after >= 0).all(axis=0)
            if fits.any():
                scaled = after * scale[:, None]
                score = np.where(fits, np.einsum("ij,ij->j", scaled, scaled), np.inf)
                at = int(score.argmin())
        if at < 0:
            if active == left.shape[1]:
                left, names = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([names, np.empty_like(names)])
            at, active = active, active + 1
            left[:, at], names[at] = caps, len(used)
            used.append(0)
        chosen = int(names[at])
        bins[i], offsets[i] = chosen, used[chosen]
        used[chosen] += length
        left[:, at] -= need
        if (left[:, at] <= 0).any():  # full: nothing fits any more
            keep = np.arange(active) != at
            left[:, : active - 1], names[: active - 1] = left[:, :active][:, keep], names[:active][keep]
            active -= 1
    return bins, offsets


def pack(
    cut: DataFrame, max_tokens: int = MAX_TOKENS, max_documents: int = MAX_DOCUMENTS,
    max_cost: int = MAX_COST, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Give every row of ``pieces`` a sequence and a place in it."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    short, whole = cut.where(F.col("length") < max_tokens), cut.where(F.col("length") >= max_tokens)
    groups = max(1, round(short.count() / group_pieces))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "copy"], ascending=[False, True, True])
        bins, rows["offset"] = best_fit(rows["length"].to_numpy(), max_tokens, max_documents, max_cost)
        rows["sequence_id"] = (rows["pack_group"].to_numpy().astype(np.int64) << 40) + bins
        return rows[[*columns, "sequence_id", "offset"]]

    group = F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(groups)).cast("int")
    filled = short.withColumn("pack_group", group).groupBy("pack_group").applyInPandas(fill, _PACKED)
    alone = (-1 - F.monotonically_increasing_id()).alias("sequence_id")
    return filled.unionByName(whole.select(*columns, alone, F.lit(0).cast("long").alias("offset")))


def packed(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, keep: int = KEEP_CHUNKS) -> DataFrame:
    """Cut and pack ``docs``; pieces are staged, so that texts are tokenised once."""
    import public_tokenizers

    cut = stage(pieces(docs, vocabulary or public_tokenizers.path("byte_bpe_50k.json"), keep=keep), "pieces")
    return pack(cut)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, documents(spark, sf_dir))
