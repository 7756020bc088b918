"""Near copies by five-word shingles: SimHash with Golay keys finds pairs, exact Jaccard decides.

Two texts are linked if their sets of five-word shingles (ASCII letters lower-cased, words between
ASCII white space, a shorter text is one shingle) have a Jaccard similarity of at least 0.8. All
texts that links connect form a component.

* Equal sets are one node from the start, however many texts have them.
* A node has a SimHash of ``BITS`` bits. At similarity 0.8 its sets are 27 degrees apart, so about
  39 of 256 bits differ, while unrelated sets differ in about 128.
* A key is a Golay codeword of a segment of 23 bits (words of odd parity also give the codewords 4
  bits away) with some equal bits from elsewhere. ``GROUP`` unrelated nodes may share one: comparing
  SimHashes costs less than more keys. Up to 600,000 nodes need no equal bits and one table for each of
  nine segments; beyond, every doubling takes one more bit, which leaves the groups as they are and
  makes keys a node grow with the fourth root of the number of nodes. ``RECALL`` of the pairs at 0.8
  would share a key if tables were independent.
* A key carries the SimHash, and nodes of a key within ``RADIUS`` bits are linked into a forest. This may
  link too much, so it makes only the *areas* within which shingle sets are compared; links of sets are exact.

Crowded keys and large areas are cut into blocks of which every two meet, as in ``simhash``; an area of
many blocks sends each text once per block. What is left to chance is only which pairs share a key.

Defined results: as for ``simhash``; NULL, empty and blank texts are equal.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scalargrid.llm.common import attach, keep_rows, maybe_among, partitions, stage
from scalargrid.llm.components import components
from scalargrid.llm.golay import LENGTH, nearest
from scalargrid.llm.simhash import text_mark

WORDS = 5
SIMILAR = (4, 5)  # at least 4/5
BITS = 256
SEGMENTS = BITS // LENGTH
RADIUS = 68
RECALL = 0.99
# At similarity 0.8: the chance that a bit is equal, and that segments of 23 bits share a codeword.
_SAME_BIT, _SAME_CODEWORD = 0.8485, 0.403
_CODEWORDS, _KEYS = 4096, 3.5  # of a segment; of a node in a table, on average
GROUP = 512  # unrelated nodes that may share a key, on average
BLOCK = 4096  # nodes of a key
AREA_NODES, AREA_CHARS = 1024, 16_000_000  # a block of an area
_STEP = 20_000  # shingles counted at once
_ROWS = 64  # SimHashes compared with all others of a group at once


def shingles(text: str | None, words: int = WORDS) -> list[bytes]:
    """Shingles of a text, each once."""
    parts = (text or "").encode().lower().split()
    if len(parts) < words:
        return [b" ".join(parts)] if parts else []
    return list(set(map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))))


def hashed(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of shingles as ascending 64-bit hashes."""
    import xxhash

    digests = b"".join(map(xxhash.xxh64_digest, shingles(text, words)))
    return np.unique(np.frombuffer(digests, dtype=np.uint64))


def sketch(text: str | None, words: int = WORDS) -> tuple[int, bytes | None]:
    """Hash of the set, and ``BITS`` bits: a bit is 1 if it is set in over half of the shingles' hashes."""
    import xxhash

    parts = shingles(text, words)
    if not parts:
        return 0, None
    digests = b"".join(map(xxhash.xxh64_digest, parts))
    node = xxhash.xxh64_intdigest(np.unique(np.frombuffer(digests, dtype=np.uint64)).tobytes()) - (1 << 63)
    halves = (b"".join(map(partial(xxhash.xxh3_128_digest, seed=seed), parts)) for seed in (1, 2))
    one, two = (np.frombuffer(h, dtype=np.uint8).reshape(-1, 16) for h in halves)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(one), _STEP):
        counts += np.unpackbits(np.hstack([one[at : at + _STEP], two[at : at + _STEP]]), axis=1).sum(axis=0, dtype=np.int64)
    return node, np.packbits(2 * counts > len(parts)).tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp, chars = [], [], []
            for value in batch.column(2):
                text = value.as_py()
                one, bits = sketch(text)
                node.append(one)
                fp.append(bits)
                chars.append(len(text or ""))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(node, pa.int64()), pa.array(fp, pa.binary()), pa.array(chars, pa.int64())],
                names=["doc_id", "mark", "node", "fp", "chars"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark(), F.col("text").cast("string").alias("text")).mapInArrow(
        each, "doc_id long, mark long, node long, fp binary, chars long"
    )


def tables_for(nodes: int) -> tuple[int, int]:
    """Equal bits in a key and number of tables, for so many nodes."""
    equal = min(28, max(0, math.ceil(math.log2(max(1.0, _KEYS * nodes / _CODEWORDS / GROUP)))))
    chance = _SAME_CODEWORD * _SAME_BIT**equal
    return equal, math.ceil(math.log(1 - RECALL) / math.log(1 - chance))


def golay_keys(prints: np.ndarray, equal: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of SimHashes (rows of ``BITS`` / 8 bytes), and the index of the row of each."""
    bits = np.unpackbits(prints, axis=1)
    every = np.arange(len(prints))
    words = [bits[:, i * LENGTH : (i + 1) * LENGTH].astype(np.int64) @ (1 << np.arange(LENGTH)) for i in range(SEGMENTS)]
    coded = []
    for word in words:
        near, away = nearest(word.astype(np.uint32))
        odd = np.flatnonzero(np.bitwise_count(word) & 1)
        row, column = np.nonzero(away[odd] >= 0)
        coded.append((np.concatenate([near, away[odd[row], column]]).astype(np.int64), np.concatenate([every, odd[row]])))
    keys, owners = [], []
    for t in range(tables):
        at = t % SEGMENTS
        other = np.setdiff1d(np.arange(BITS), np.arange(at * LENGTH, (at + 1) * LENGTH))
        chosen = np.random.default_rng(t).choice(other, equal, replace=False)
        exact = bits[:, chosen].astype(np.int64) @ (1 << np.arange(equal))
        index, owner = coded[at]
        keys.append(t << 40 | exact[owner] << 12 | index)
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what ``near`` connects; it tells which of the given items link to one."""
    links: list[tuple[int, int]] = []
    rest = np.arange(count)
    queue: list[int] = []
    while len(rest):
        if queue:
            head = queue.pop()
        else:
            head, rest = int(rest[0]), rest[1:]
            if not len(rest):
                break
        hit = near(head, rest)
        reached = rest[hit].tolist()
        links += [(head, other) for other in reached]
        queue += reached
        rest = rest[~hit]
    return links


def accompanied(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """True for SimHashes (rows of unsigned 64-bit words) with another one within ``radius`` bits."""
    words = np.ascontiguousarray(prints.T)
    found = np.zeros(len(prints), dtype=bool)
    for at in range(0, len(prints), _ROWS):
        end = min(at + _ROWS, len(prints))
        apart = np.zeros((end - at, len(prints) - at), dtype=np.uint16)
        for word in words:
            apart += np.bitwise_count(word[at:end, None] ^ word[None, at:])
        near = apart <= radius
        np.fill_diagonal(near, False)
        found[at:end] |= near.any(axis=1)
        found[at:] |= near.any(axis=0)
    return found


def print_links(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Forest of SimHashes (rows of unsigned 64-bit words) within ``radius`` bits; most have none near."""
    own = np.flatnonzero(accompanied(prints, radius))
    some = prints[own]
    links = forest(len(own), lambda i, rest: np.bitwise_count(some[rest] ^ some[i]).sum(axis=1, dtype=np.int64) <= radius)
    return [(int(own[a]), int(own[b])) for a, b in links]


def set_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Forest of sets of hashes whose Jaccard similarity is at least ``SIMILAR``."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    part, whole = SIMILAR

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        hit = (sizes[rest] * whole >= sizes[i] * part) & (sizes[i] * whole >= sizes[rest] * part)
        tried = np.flatnonzero(hit)
        for at in range(0, len(tried), 256):
            some = rest[tried[at : at + 256]]
            flat = np.concatenate([sets[j] for j in some.tolist()])
            place = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            common = np.add.reduceat((sets[i][place] == flat).astype(np.int64), starts)
            hit[tried[at : at + 256]] = common * whole >= part * (sizes[some] + sizes[i] - common)
        return hit

    return forest(len(sets), near)


def _runs(find: Callable[[list[pa.Array]], list[tuple[int, int]]]):
    """Links within runs of equal ``group``, the first column; rows come sorted by it. The second has the nodes."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def links(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            groups, nodes = (rows.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            pairs: list[tuple[int, int]] = []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(groups)], strict=True):
                if end - start > 1:
                    own = nodes[start:end]
                    columns = [rows.column(i).slice(start, end - start) for i in range(2, rows.num_columns)]
                    pairs += [(int(own[a]), int(own[b])) for a, b in find(columns)]
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            rows = new if kept is None else pa.concat_tables([kept, new])
            groups = rows.column(0).to_numpy()
            earlier = np.flatnonzero(groups != groups[-1])
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            kept = rows.slice(last)
            if last:
                yield links(rows.slice(0, last))
        if kept is not None:
            yield links(kept)

    return verify


def _find_prints(columns: list) -> list[tuple[int, int]]:
    return print_links(_bytes(columns[0], BITS // 8).view(np.uint64))


def _find_sets(columns: list) -> list[tuple[int, int]]:
    return set_links([hashed(t) for t in columns[0].to_pylist()])


def _meet(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``group`` and ``columns``: every two of the ``parts`` blocks of a key meet in one group."""
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = rows.withColumn("own", own).select(
        key, "own", *columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    return dealt.select(F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other")).alias("group"), *columns)


def area_links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect nodes within ``RADIUS`` bits that share a key."""
    n = partitions(nodes.sparkSession)
    nodes = nodes.where("fp IS NOT NULL").select("node", "fp")
    equal, tables = tables_for(nodes.count())

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys, owners = golay_keys(_bytes(part.column(1), BITS // 8), equal, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), *(part.column(i).take(pa.array(owners)) for i in (0, 1))], names=["key", "node", "fp"]
                )

    keys = nodes.mapInArrow(keyed, "key long, node long, fp binary")
    crowded = stage(keys.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > block), "near-keys")
    met = keys.join(crowded, "key", "left").withColumn("parts", F.ceil(F.coalesce("m", F.lit(1)) / block).cast("int"))
    grouped = _meet(met, "key", ["node", "fp"])
    return grouped.repartition(n, "group").sortWithinPartitions("group").mapInArrow(_runs(_find_prints), "a long, b long")


def near_groups(docs: DataFrame, area_nodes: int = AREA_NODES) -> DataFrame:
    """``doc_id, mark, component_id`` of every row."""
    n = partitions(docs.sparkSession)
    rows = stage(sketches(docs), "near-sketches")
    nodes = stage(rows.groupBy("node").agg(
        F.count("*").alias("group_rows"), F.min("doc_id").alias("first"), F.min("mark").alias("mark"),
        F.max("chars").alias("chars"), F.first("fp").alias("fp"),
    ), "near-nodes")
    areas = stage(components(area_links(nodes)), "near-areas")
    placed = nodes.select("node", "mark", "chars").join(areas, "node")
    sizes = placed.groupBy("root").agg(F.count("*").alias("m"), F.sum("chars").alias("c")).select(
        "root", F.ceil(F.greatest(F.col("m") / area_nodes, F.col("c") / AREA_CHARS)).cast("int").alias("parts")
    )
    wanted = stage(placed.join(stage(sizes, "near-sizes"), "root").select("node", "root", "parts", F.col("mark").alias("own_mark")), "near-wanted")
    texts = docs.select(text_mark(), F.col("text").cast("string").alias("text"))
    # Equal texts have one mark: one of each is compared. They combine before the shuffle; no other text is shuffled.
    held = maybe_among(texts, "mark", wanted.select("own_mark")).where("_maybe")
    needed = held.groupBy("mark").agg(F.first("text").alias("text"))
    compared = _meet(wanted.join(needed, wanted.own_mark == needed.mark), "root", ["node", "text"])
    links = compared.repartition(n, "group").sortWithinPartitions("group").mapInArrow(_runs(_find_sets), "a long, b long")
    roots = components(links)
    named = nodes.select("node", "group_rows", "first").join(roots, "node", "left").select(
        "node", "group_rows", "first", F.coalesce("root", "node").alias("root")
    )
    members = stage(named, "near-members")
    least = stage(members.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("group_rows").alias("rows")), "near-least")
    found = members.join(least.where("rows > 1"), "root").select("node", "group_rows", "component_id")
    shown = attach(rows.select("doc_id", "mark", "node"), stage(found, "near-named"), "node", ["component_id"])
    return shown.select("doc_id", "mark", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest ``doc_id`` of each component, all columns as they were."""
    kept = F.col("component_id").eqNullSafe(F.col("doc_id"))
    return keep_rows(docs, text_mark(), stage(near_groups(docs).select("doc_id", "mark", kept.alias("kept")), "near-kept"))
