"""One key with a third of all rows: results stay whole, and no group takes that key as a whole."""

from __future__ import annotations

from collections import Counter, defaultdict
from zlib import crc32

import xxhash
from pyspark.sql import functions as F

from scalargrid.llm import packing, sharding, sketches
from scalargrid.llm.common import stage

ROWS = 3000
DOCS = [(None if i % 3 == 0 else 7 if i % 3 == 1 and i % 2 else i, None if i % 50 == 0 else f"text é {i % 900}") for i in range(ROWS)]


def _place(doc_id: int | None) -> int:
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(str(doc_id).encode(), 42)
    return xxhash.xxh64_intdigest(b"ring", seed) >> (64 - sharding.RING_BITS)


def _walk(ids: list[int | None], shards: int, virtual_nodes: int) -> Counter:
    """Every document on its own goes clockwise, arc by arc, one point further each round; rows by id and shard."""
    points = sharding.ring(shards, virtual_nodes)
    room = sharding.capacities(len(ids), shards)
    waiting = defaultdict(list)
    behind = lambda place: place > points[-1][0]  # the arc of the first point starts there
    for doc_id in sorted(ids, key=lambda d: (not behind(_place(d)), _place(d))):
        place = _place(doc_id)
        waiting[0 if behind(place) else next(i for i, (p, _) in enumerate(points) if p >= place)].append(doc_id)
    found: Counter = Counter()
    for step in range(len(points)):
        for arc in range(len(points)):
            shard = points[(arc + step) % len(points)][1]
            while waiting[arc] and room[shard]:
                found[waiting[arc].pop(0), shard] += 1
                room[shard] -= 1
    return found


def test_ring_with_a_third_of_all_rows_on_one_id(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    for crowd in (40, sharding.CROWD):
        rows = sharding.assign(docs, 5, 8, crowd).collect()
        raw = [(d, (t or "").encode()) for d, t in DOCS]
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len(t) + 1, crc32(t)) for d, t in raw)
        assert Counter((r.doc_id, r.shard) for r in rows) == _walk([d for d, _ in DOCS], 5, 8)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_crowded_places_are_cut_in_ring_order(spark):
    # Piece 0: a few rows around two crowded places; piece 1: as many rows, no place crowded; piece 2: few rows.
    placed = [(0, p) for p in [1, 3, 5] for _ in range(2)] + [(0, p) for p in (2, 4) for _ in range(700)]
    placed += [(1, 100 + i) for i in range(1400)] + [(2, 5000)] * 20
    rows = stage(
        spark.createDataFrame(placed, "piece int, place long").withColumn("salt", F.monotonically_increasing_id()), "placed"
    )
    sizes = {0: 1406, 1: 1400, 2: 20}
    cut = sharding.uncrowded(rows, sizes, 1000, 100)
    runs = cut.groupBy("piece", "level", "part").agg(F.count("*"), F.min("place"), F.max("place")).collect()
    assert sum(n for *_, n, _, _ in runs) == len(placed)
    assert {(p, level, low) for p, level, _, _, low, high in runs if p == 0 and low == high} == {
        (0, 0, 1), (0, 1, 2), (0, 2, 3), (0, 3, 4), (0, 4, 5)
    }
    assert max(n for p, _, _, n, _, _ in runs if p == 0) <= 200
    assert sorted((p, level, n) for p, level, _, n, _, _ in runs if p) == [(1, 0, 1400), (2, 0, 20)]


def test_whole_pieces_stay_out_of_groups(spark):
    """Long documents have whole pieces for the most part; one id has a third of all."""
    limit = 64
    cut = []
    for copy in range(600):
        first = copy % limit + 1
        bounds = [0, *range(first, first + 30 * limit + 1, limit)]
        doc = None if copy % 3 == 0 else copy
        cut += [(doc, copy, k, a, b - a, copy) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    rows = packing.pack(
        spark.createDataFrame(cut, packing._PIECE), limit, limit, limit**2, group_pieces=100
    ).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter((d, *rest) for d, _, *rest in cut)
    whole = [r for r in rows if r.length == limit]
    assert all(r.sequence_id < 0 and r.offset == 0 for r in whole) and len({r.sequence_id for r in whole}) == len(whole)
    filled = defaultdict(list)
    for r in rows:
        if r.length < limit:
            filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= limit
    groups = Counter(s >> 40 for s, places in filled.items() for _ in places)
    assert min(groups) >= 0 and max(groups.values()) <= 200
    assert len(filled) <= 1.1 * sum(n for p in filled.values() for _, n in p) / limit + len(groups)


def _followed(docs, ranges: int) -> tuple[Counter, list]:
    """Ids, texts and their next texts, and the rows that windows saw."""
    dealt, order, left_out = sketches.with_next(docs, ranges)
    rows = dealt.withColumn("next", F.lead("text").over(order)).collect()
    found = Counter((r.doc_id, r.hash, r.text, r.next) for r in rows if not r.guest)
    hashes = {(r.doc_id, r.text): r.hash for r in rows}
    if left_out is not None:
        for r in sketches.repeated(left_out, 100).collect():
            found[r.doc_id, hashes[r.doc_id, r.text], r.text, r.text] += 1
    return found, rows


def _line(found: Counter) -> Counter:
    """What should follow what: by id, NULL first, then by hash and text."""
    texts = sorted(((d is not None, d or 0, h, t), d) for (d, h, t, _), n in found.items() for _ in range(n))
    return Counter((d, at[2], at[3], after[0][3]) for (at, d), after in zip(texts, [*texts[1:], *texts[:1]], strict=True))


def test_next_documents_with_a_third_of_all_rows_on_one_id(spark):
    """NULL ids hold a third of all rows, and half of those one text; ranges stay even, and each row has its next."""
    rows = [(None, "the same" if i % 2 else f"null {i}") if i % 3 == 0 else (i, f"text {i}") for i in range(3000)]
    rows += [(5, f"five {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for ranges in (1, 12, 40):
        found, seen = _followed(docs, ranges)
        own: Counter = Counter()
        for (doc_id, _, text, _), n in found.items():
            own[doc_id, text] += n
        assert own == Counter(rows)
        assert found == _line(found)
        sizes = Counter(r.bucket for r in seen)
        if ranges > 1:
            assert max(sizes.values()) <= 3 * len(rows) / ranges
            assert sum(sizes.values()) - len(rows) <= len(rows) / 20


def test_next_documents_of_plain_and_odd_ids(spark):
    far = [(2**62 + 3 * i if i % 3 else 2**61 + 1, f"t{i}") for i in range(200)]
    for rows in (far, [], [(1, "a")], [(None, None)] * 5, [(3, "c"), (1, "a"), (2, None)], [(9, "x")] * 50 + [(10, "y")]):
        found, _ = _followed(spark.createDataFrame(rows, "doc_id long, text string"), 8)
        assert Counter((d, t) for (d, _, t, _), n in found.items() for _ in range(n)) == Counter((d, t or "") for d, t in rows)
        assert found == _line(found)
