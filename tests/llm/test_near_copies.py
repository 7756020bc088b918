"""The near-copy stage of the pipeline against all pairs of shingle sets."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from scalargrid.llm import near_copies


def planted() -> list[tuple[int, str]]:
    """Families of texts: 0 to 4 words of 120 changed, so that neighbours are similar by 0.7 to 1."""
    random = np.random.default_rng(8)
    rows: list[tuple[int, str]] = []
    for _ in range(40):
        words = [f"w{v}" for v in random.integers(0, 50_000, 120)]
        for _ in range(6):
            changed = list(words)
            for at in random.integers(0, 120, random.integers(0, 5)):
                changed[at] = f"x{random.integers(0, 50_000)}"
            rows.append((len(rows), " ".join(changed)))
    return rows


def brute_force(rows: list[tuple[int, str]]) -> dict[int, int]:
    sets = []
    for _, text in rows:
        words = text.lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = {i: i for i, _ in rows}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for b in range(len(rows)):
        for a in range(b):
            if not sets[a] and not sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                root[y] = x
    return {i: find(i) for i in root}


def test_components_are_those_of_all_pairs(spark):
    rows = planted()
    rows += [(1000 + i, t) for i, t in enumerate(["", " \n", "a", "A", "a b", rows[0][1].upper(), rows[7][1].replace(" ", "\t")])]
    want = brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for area_nodes in (near_copies.AREA_NODES, 2):  # an area in one block, and in several
        got = {r["doc_id"]: r["component_id"] for r in near_copies.near_groups(docs, area_nodes).collect()}
        # Which pairs share a key is left to chance, links are not: nothing may be linked that all pairs do not link.
        assert all(want[i] == want[got[i]] for i in want)
        apart = sum(got[i] != want[i] for i in want)
        assert apart <= 0.02 * len(want), apart


def test_the_stage_drops_a_copy_with_changed_words(spark):
    random = np.random.default_rng(9)
    words = [f"w{v}" for v in random.integers(0, 50_000, 200)]
    other = list(words)
    for at in (30, 31, 120):  # similar by 0.87, about 30 bits of 256 apart
        other[at] = "changed"
    far = list(words)
    for at in range(10, 200, 20):  # similar by 0.6
        far[at] = "changed"
    rows = [(i, " ".join(w), "a") for i, w in enumerate((words, other, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_copies_out(spark, docs, "").collect()) == [0, 2]


def test_keys_of_similar_texts(spark):
    """Pairs at 0.8 share a key however many nodes there are, and keys a node stay few."""
    random = np.random.default_rng(10)
    pairs: dict[float, list[np.ndarray]] = {0.8: [], 0.9: []}
    for _ in range(400):
        words = [f"w{v}" for v in random.integers(0, 50_000, 150)]
        other = list(words)
        for at in random.integers(0, 150, random.integers(1, 4)):
            other[at] = "changed"
        a, b = (set(near_copies.shingles(" ".join(w))) for w in (words, other))
        similar = len(a & b) / len(a | b)
        if similar >= 0.8:
            prints = np.frombuffer(b"".join(near_copies.sketch(" ".join(w))[1] for w in (words, other)), np.uint8).reshape(2, -1)
            pairs[0.9 if similar >= 0.9 else 0.8].append(prints)
    assert len(pairs[0.8]) > 50
    for nodes, most in ((1000, 40), (250_000, 40), (15_000_000, 90), (10**9, 240)):
        for similar, least in ((0.8, 0.9), (0.9, 0.99)):
            flat = np.concatenate(pairs[similar])
            keys, owners = near_copies.golay_keys(flat, *near_copies.tables_for(nodes))
            assert len(keys) <= most * len(flat)
            own = [set(keys[owners == i].tolist()) for i in range(len(flat))]
            assert np.mean([bool(own[i] & own[i + 1]) for i in range(0, len(own), 2)]) > least


def test_links_of_prints_connect_what_all_pairs_connect():
    random = np.random.default_rng(11)
    heads = random.integers(0, 2**63, (60, 4), dtype=np.uint64)
    prints = np.repeat(heads, random.integers(1, 12, 60), axis=0)
    for row in prints:  # up to 40 bits changed: members of a family are up to 80 apart
        for bit in random.integers(0, 256, random.integers(0, 41)):
            row[bit // 64] ^= np.uint64(1 << int(bit % 64))
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2, dtype=np.int64) <= near_copies.RADIUS
    links = near_copies.print_links(prints)
    assert all(near[a, b] for a, b in links)
    assert len(set(links)) == len(links)
    np.fill_diagonal(near, False)
    assert (near_copies.accompanied(prints) == near.any(axis=1)).all()
    reach, own = near | np.eye(len(near), dtype=bool), np.eye(len(near), dtype=bool)
    for a, b in links:
        own[a, b] = own[b, a] = True
    for _ in range(8):
        reach, own = reach @ reach, own @ own
    assert (reach == own).all()


def test_crowded_keys_are_cut_into_blocks(spark):
    """Every two blocks of a crowded key meet, so that the same nodes are connected."""
    random = np.random.default_rng(12)
    rows = []
    for family in range(3):
        head = random.integers(0, 256, 32, dtype=np.uint8)
        for _ in range(40):
            bits = np.unpackbits(head)
            bits[random.integers(0, 256, 6)] ^= 1
            rows.append((len(rows), bytearray(np.packbits(bits).tobytes()), family))
    nodes = spark.createDataFrame(rows, "node long, fp binary, family int")
    for block in (near_copies.BLOCK, 7):
        root = list(range(len(rows)))

        def find(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        for a, b in near_copies.area_links(nodes, block).collect():
            assert rows[a][2] == rows[b][2]
            root[find(a)] = find(b)
        assert len({find(i) for i in root}) == 3
