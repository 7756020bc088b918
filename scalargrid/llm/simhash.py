"""Operator 5: SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint per text; fingerprints that differ in at most 3 bits are linked, and all
texts that links connect form a component. Finding the links:

* Equal fingerprints are one row from the start, however many texts have them.
* A fingerprint has four segments of 16 bits. Of 3 differing bits, one segment at least gets
  none; of the other three, at most one gets more than one. So among any two of these three one
  has at most one. Keys are made of an equal segment and a fuzzy one: 4 x 2 pairs of segments.
* A fuzzy segment is decoded by the Golay code of length 23 (padded with zeros). If two values
  differ by one bit, they have the same nearest codeword, or each lies 3 from its own and 4 from
  the other's. Their parities differ, so it is enough that values of odd parity also give the five
  codewords that are 4 away. No pair within 3 bits is missed.
* Keys that two fingerprints share are candidates, which are verified by counting bits.

A key that many fingerprints share is cut into blocks by hash, and every two blocks meet in a
group of their own, so no task holds more than two blocks. Within a group only a spanning forest
of its links is emitted, never all pairs: a fingerprint takes all within 3 bits as its cluster,
and clusters are then compared until they are connected.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like any
other; a component's id is the smallest ``doc_id`` in it (NULLs apart, unless all are NULL);
rows that repeat a ``doc_id`` each get a row; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import attach, documents, keep_rows, partitions, stage
from scalargrid.llm.components import components
from scalargrid.llm.golay import codeword_keys

WORDS = 3
MAX_BITS = 3
BLOCK = 4096
_SEED = 42
_SMALL = 24  # groups up to this size are compared pair by pair
_STEP = 50_000  # shingles counted at once


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits: a bit is 1 if it is set in over half of the shingles' hashes."""
    import xxhash

    parts = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space are meant
    if not parts:
        return 0
    digest = partial(xxhash.xxh64_digest, seed=_SEED)
    shingles = [b" ".join(parts)] if len(parts) < words else map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    hashes = np.frombuffer(b"".join(map(digest, shingles)), dtype=np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        counts += np.unpackbits(hashes[at : at + _STEP], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def text_mark() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, mark, fp``: the 64 bits as a signed number; ``mark`` is a hash of the whole text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(values.view(np.int64))], names=["doc_id", "mark", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark(), F.col("text").cast("string").alias("text")).mapInArrow(
        each, "doc_id long, mark long, fp long"
    )


def segment_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints, and the index of the fingerprint of each."""
    near, away = codeword_keys(16)
    segments = [(values >> np.uint64(16 * i)).astype(np.uint16) for i in range(4)]
    keys, owners = [], []
    every = np.arange(len(values))
    for fuzzy in range(4):
        part = segments[fuzzy]
        odd = np.flatnonzero(np.bitwise_count(part) & 1)
        far = away[part[odd]]
        row, column = np.nonzero(far >= 0)
        owner = np.concatenate([every, odd[row]])
        index = np.concatenate([near[part], far[row, column]]).astype(np.int64)
        for step in (1, 2):
            equal = (fuzzy + step) % 4
            tag = (fuzzy * 2 + step - 1) << 28
            keys.append(tag | segments[equal][owner].astype(np.int64) << 12 | index)
            owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        keys, owners = segment_keys(values.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[owners])], names=["key", "fp"])


def forest(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links, at most one fewer than values, that connect what pairs within ``max_bits`` connect."""
    links: list[tuple[int, int]] = []
    clusters: list[np.ndarray] = []
    rest = values
    while len(rest):
        head = rest[0]
        close = np.bitwise_count(rest ^ head) <= max_bits
        cluster = rest[close]
        links += [(int(head), int(v)) for v in cluster[1:]]
        clusters.append(cluster)
        rest = rest[~close]
    parent = list(range(len(clusters)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    heads = np.array([c[0] for c in clusters], dtype=np.uint64)
    for i, cluster in enumerate(clusters[:-1]):
        # Members lie within max_bits of their heads, so heads of linked clusters lie within three times that.
        for j in (np.flatnonzero(np.bitwise_count(heads[i + 1 :] ^ heads[i]) <= 3 * max_bits) + i + 1).tolist():
            if root(i) == root(j):
                continue
            for at in range(0, len(cluster), 512):
                hit = np.argwhere(np.bitwise_count(cluster[at : at + 512, None] ^ clusters[j][None, :]) <= max_bits)
                if len(hit):
                    links.append((int(cluster[at + hit[0, 0]]), int(clusters[j][hit[0, 1]])))
                    parent[root(j)] = root(i)
                    break
    return links


def _verified(max_bits: int):
    """Links within runs of equal group; rows come sorted by group."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((2, 0), dtype=np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            groups, values = rows[0], rows[1].view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            sizes = np.diff(np.append(starts, len(groups)))
            large = np.repeat(sizes > _SMALL, sizes)
            a, b = [], []
            for lag in range(1, min(_SMALL, int(sizes.max())) if len(sizes) else 0):
                one, two = values[:-lag], values[lag:]
                hit = (groups[:-lag] == groups[lag:]) & ~large[:-lag] & (np.bitwise_count(one ^ two) <= max_bits)
                a.append(one[hit])
                b.append(two[hit])
            for start, size in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist(), strict=True):
                pairs = np.array(forest(np.unique(values[start : start + size]), max_bits), dtype=np.uint64).reshape(-1, 2)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
            one, two = (np.concatenate([np.empty(0, np.uint64), *x]).view(np.int64) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=["a", "b"])

        for batch in batches:
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            rows = np.concatenate([kept, new], axis=1)
            if not rows.shape[1]:
                continue
            earlier = np.flatnonzero(rows[0] != rows[0, -1])
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            kept = rows[:, last:]
            if last:
                yield links(rows[:, :last])
        if kept.shape[1]:
            yield links(kept)

    return verify


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between different fingerprints (``fp``, distinct) that connect all within ``max_bits``."""
    if max_bits > MAX_BITS:
        raise ValueError(f"four segments find at most {MAX_BITS} differing bits")
    n = partitions(prints.sparkSession)
    keys = prints.select("fp").mapInArrow(_keyed, "key long, fp long")
    shared = stage(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "shared-keys")
    parts = F.ceil(F.col("m") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = keys.join(shared, "key").withColumn("parts", parts).withColumn("own", own)
    # Every two blocks of a key meet in one group; a key of one block is one group.
    grouped = met.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"), "fp"
    )
    return grouped.repartition(n, "group").sortWithinPartitions("group").mapInArrow(_verified(max_bits), "a long, b long")


def near_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, mark, fp, component_id`` of every row."""
    rows = stage(fingerprints(docs, words), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.count("*").alias("group_rows"), F.min("doc_id").alias("first")), "prints")
    roots = components(fingerprint_links(prints, max_bits))
    members = stage(prints.join(roots, prints.fp == roots.node, "left").select("fp", "group_rows", "first", F.coalesce("root", "fp").alias("root")), "members")
    least = stage(members.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("group_rows").alias("rows")), "least")
    named = members.join(least.where("rows > 1"), "root").select("fp", "group_rows", "component_id")
    placed = attach(rows, stage(named, "named"), "fp", ["component_id"])
    return placed.select("doc_id", "mark", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the smallest ``doc_id`` of each component, all columns as they were."""
    groups = near_groups(docs, words, max_bits)
    kept = F.col("component_id").eqNullSafe(F.col("doc_id"))
    return keep_rows(docs, text_mark(), stage(groups.select("doc_id", "mark", kept.alias("kept")), "near-kept"))


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
