"""Operator 4: token ids as wavelet matrices, one compressed file per shard.

Texts are dealt by ranges of ``doc_id``, so shard after shard holds ascending ids. A shard is
one Parquet file, zstd-compressed, of one row per block: bit-planes, rank directory, and id and
token count of each document. A block ends with the first document that takes it to
``block_tokens``, so a document lies in one block and a task holds one block at a time. Ids can
be counted, found and read at any place of a block without decoding it.

Defined results: NULL texts count as empty and have only the end id; a NULL ``doc_id`` sorts
first; rows that repeat a ``doc_id`` all keep their own place, in no fixed order among
themselves; an empty table gives no file and no row; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, partitions
from scalargrid.llm.encoding import encoder
from scalargrid.llm.wavelet import WaveletMatrix
from scalargrid.runtime import shared_dir

END_ID = 1
# UTF-8 bytes of texts encoded at once; their chunks, numbers and ids take about ten times as much.
SLICE_BYTES = 16 << 20
_FILE = (
    "shard int, block int, shard_start long, n long, zeros array<long>, planes binary, "
    "ranks binary, doc_ids array<long>, lengths array<long>"
)
_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()), ("n", pa.int64()),
    ("zeros", pa.list_(pa.int64())), ("planes", pa.binary()), ("ranks", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])


def _slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts of about ``SLICE_BYTES`` at most; a longer text is one alone."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)
    start = done = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield slice(start, stop)
        start, done = stop, int(ends[stop - 1])


def _blocks(path: str, end_id: int, block_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        block = start = size = 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        lengths: list[int] = []
        encode = encoder(path, False).encode_all

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([WaveletMatrix.build(np.concatenate(ids)).to_row() | {
                "shard": shard, "block": block, "shard_start": start, "doc_ids": docs, "lengths": lengths,
            }], schema=_ARROW)

        for batch in batches:
            for part in _slices(batch.column(1)):
                more, counts = encode(batch.column(1)[part], end_id)
                reach, names = np.cumsum(counts), batch.column(0)[part].to_pylist()
                first = taken = 0
                while first < len(names):
                    # Up to the first document that takes the block to block_tokens, or all.
                    last = min(int(np.searchsorted(reach, taken + block_tokens - size)) + 1, len(names))
                    upto = int(reach[last - 1])
                    ids.append(more[taken:upto])
                    docs += names[first:last]
                    lengths += counts[first:last].tolist()
                    size += upto - taken
                    first, taken = last, upto
                    if size >= block_tokens:
                        yield row()
                        block, start, size, ids, docs, lengths = block + 1, start + size, 0, [], [], []
        if ids:
            yield row()

    return write


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, block_tokens: int = 1 << 20
) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) and write one file per shard below ``folder``."""
    spark = docs.sparkSession
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(_blocks(vocabulary, end_id, block_tokens), _FILE)
        .write.option("compression", "zstd").parquet(folder)
    )


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``shard`` and ``base``, the ids in all shards before it: one small row per written file."""
    sizes = spark.read.schema(_FILE).parquet(folder).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    base, rows = 0, []
    for shard, n in sorted(map(tuple, sizes)):
        rows.append((shard, base))
        base += n
    return spark.createDataFrame(rows, "shard int, base long")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    blocks = spark.read.schema(_FILE).parquet(folder).drop("ranks")
    placed = blocks.join(F.broadcast(shard_starts(spark, folder)), "shard").select(
        (F.col("base") + F.col("shard_start")).alias("start"), "n", "zeros", "planes", "doc_ids", "lengths"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("start", "n", "zeros", "planes", "doc_ids")}
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                ids = WaveletMatrix.from_row(row | {"ranks": np.zeros(len(row["zeros"]), "<u4").tobytes()}).decode()
                raw, ends = memoryview(ids.astype("<u4")).cast("B"), np.cumsum(lengths)
                sums = [crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "start": row["start"] + ends - lengths,
                    "n_tokens": lengths, "ids_crc32": pa.array(sums, pa.int64()),
                })

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def find_token(spark: SparkSession, folder: str, symbol: int) -> DataFrame:
    """Per block, how often an id occurs and where first: by rank and select alone, nothing decoded."""
    placed = spark.read.schema(_FILE).parquet(folder).join(F.broadcast(shard_starts(spark, folder)), "shard").select(
        (F.col("base") + F.col("shard_start")).alias("start"), "n", "zeros", "planes", "ranks"
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.from_row(row)
                first = matrix.select(symbol, 0)
                yield pa.RecordBatch.from_pylist([{
                    "start": row["start"], "occurrences": matrix.count(symbol),
                    "first": row["start"] + first if first >= 0 else None,
                }], schema=pa.schema([("start", pa.int64()), ("occurrences", pa.int64()), ("first", pa.int64())]))

    return placed.mapInArrow(look, "start long, occurrences long, first long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, folder)
