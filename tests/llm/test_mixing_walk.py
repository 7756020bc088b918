"""Mixing against a walk over blocks and documents, with a third of all rows under one id or source."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from scalargrid.llm import mixing

BLOCKS = 8


def _hash(*values: int | str | None) -> int:
    """Signed, NULL leaves the seed as it is."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(4, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _name(doc_id: int | None) -> str | None:
    return None if doc_id is None else str(doc_id)


def _walk(docs: list[tuple], repeats: float) -> Counter:
    sizes, blocks = Counter(), defaultdict(lambda: defaultdict(list))
    for doc_id, source, text in docs:
        n = len((text or "").split())
        sizes[source] += n
        blocks[source][_hash(_name(doc_id), "block") % BLOCKS].append((doc_id, n))
    keys = {s: "-" if s is None else f"={s}" for s in sizes}
    ordered = {keys[s]: sizes[s] for s in sorted(sizes, key=keys.get)}
    times = mixing.repeats(ordered, mixing.bisected(ordered, max_repeats=repeats))
    found = Counter()
    for source, own in blocks.items():
        often = times[keys[source]]
        for copy in range(max(1, int(-(-(often - 1e-9) // 1)))):
            share = min(1.0, often - copy)
            budget = float("inf") if share > 1 - 1e-9 else sizes[source] * share
            before = 0
            for rank, block in enumerate(sorted(own, key=lambda b: (_hash(b, copy), b))):
                if before >= budget:
                    break
                total = sum(n for _, n in own[block])
                turns = defaultdict(list)
                for doc_id, n in own[block]:
                    turns[_hash(_name(doc_id), copy, "turn")].append((doc_id, n))
                passed = before
                for turn in sorted(turns):
                    if before + total > budget and passed >= budget:
                        break
                    for doc_id, n in turns[turn]:
                        at = _hash(_name(doc_id), copy, "place") % (1 << 30) / (1 << 30)
                        found[doc_id, source, copy, block, round((copy + (rank + at) / BLOCKS) / often, 12)] += 1
                        passed += n
                before += total
    return found


@pytest.mark.parametrize("part_bits", [1, 12])
@pytest.mark.parametrize("hot", ["id", "source", "cut"])
def test_uses_are_those_of_a_walk(spark, monkeypatch, hot, part_bits):
    monkeypatch.setattr(mixing, "PART_BITS", part_bits)
    docs = []
    for i in range(900):
        doc_id = None if hot == "id" and i % 3 == 0 else 5 if hot == "cut" and i % 3 == 0 else i
        source = "a" if hot == "source" and i % 3 else None if i % 50 == 0 else "bcd"[i % 7 % 3]
        docs.append((doc_id, source, None if i % 31 == 0 else " \n" if i % 37 == 0 else "w " * (i % 40)))
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(3)
    rows = mixing.draws(frame, max_repeats=1.5, blocks=BLOCKS).collect()
    got = Counter((r.doc_id, r.source, r.copy, r.block, round(r.mix_order, 12)) for r in rows)
    assert got == _walk(docs, 1.5) and any(r.copy for r in rows)
    mixed = mixing.mixed(frame, max_repeats=1.5, blocks=BLOCKS).groupBy("doc_id", "source", "text").agg(F.count("*")).collect()
    assert sum(n for *_, n in mixed) == len(rows)
