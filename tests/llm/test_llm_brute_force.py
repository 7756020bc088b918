"""Operators against plain programs over whole small tables."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import compare, connect
from scalargrid.llm import mixing, privacy, sharding, simhash, sketches, toxicity
from scalargrid.llm.golay import codeword_keys
from scalargrid.llm.gru import Gru
from scalargrid.llm.language import Ranks, count_grams
from scalargrid.llm.packing import best_fit
from scalargrid.llm.queries import ORACLES, QUERIES
from scalargrid.llm.wavelet import WaveletMatrix
from scalargrid.llm.word_inputs import WordInputs

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows)}


def run(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}


@tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    with connect(SF_DIR) as duck:
        assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str) -> list[str]:
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if good[kind]:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans(spark, tmp_path):
    random = np.random.default_rng(5)
    bits = ["a", "b@", "@", "c.d", ".", "x@y.z", "1", "23", "456", "4539", "-", "+1", "(", "\n", "é", "😀", "%", "_", " ",
            "12.34.56.78", "300.1.1.1", "4111111111111111", "+44 20 7946 0958", "card: ", "0001.2.3.4"]
    rows = [(i, "".join(random.choice(bits, random.integers(0, 30)))) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in privacy.op1_weak_privacy(spark, str(tmp_path)).collect()}
    for i, text in rows:
        want = base_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in privacy.KINDS] == [sum(w.startswith(k) for w in want) for k in privacy.KINDS]


def test_reliabilities_follow_agreement():
    # The second labeler speaks against what three others support.
    counts = {("phone", (1, -1, 1, 1), "s"): 50, ("phone", (-1, 1, -1, 1), "s"): 50, ("phone", (0, 0, 1, 1), "t"): 5}
    told = privacy.reliabilities(counts)
    chances = privacy.classifier(counts, told)
    assert told["phone", (1, -1, 1, 1), "s"] > 0.9 > 0.1 > told["phone", (-1, 1, -1, 1), "s"]
    assert chances["phone", (1, -1, 1, 1), "s"] > 0.9 > 0.2 > chances["phone", (-1, 1, -1, 1), "s"]


@tables
def test_sketches(spark, texts):
    got, ids = run(spark, "op2_bottom_k"), sorted(texts)

    def parts(text):
        words = text.lower().split()
        return {tuple(words[max(0, i - 4) : i + 1]) for i in range(len(words))}

    errors = []
    for k, i in enumerate(ids):
        after, quarter = texts[ids[(k + 1) % len(ids)]], len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - quarter] + after[:quarter]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(texts[i])
        a = parts(texts[i])
        for name, b in (("near_edited", parts(edited)), ("near_next", parts(after))):
            errors.append(abs(got[i][name] - len(a & b) / max(1, len(a | b))))
        if len(a) < sketches.SKETCH:
            assert got[i]["distinct_shingles"] == len(a)
        else:
            assert 0.55 * len(a) < got[i]["distinct_shingles"] < 1.7 * len(a)
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.04


@tables
def test_languages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    got = run(spark, "op3_rank_order_language")
    held = [i for i in got if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i]["lang_pred"] == rows[i]["lang"] for i in held]) > 0.95


def test_rank_order_distance():
    ranks = Ranks({"b": [3, 1, 2], "a": [1, 9, 8]}, size=3)
    known, counts = count_grams(["Ab a"])
    edge, a, b = 1, ord("a"), ord("b")
    grams = [a, b, edge << 21 | a, a << 21 | b, b << 21 | edge, a << 21 | edge, edge << 42 | a << 21 | b, a << 42 | b << 21 | edge,
             edge << 42 | a << 21 | edge, b << 42 | edge << 21 | a]
    assert sorted(known.tolist()) == sorted(grams) and counts[known.tolist().index(a)] == 2
    assert ranks.predict("zz") == ("a", 0.0) and ranks.predict("1") == ("und", 0.0)


@tables
@pytest.mark.parametrize("name,file,end", [("op4_token_files", "word_bpe_49k.json", 1), ("op6_best_fit_packing", "byte_bpe_50k.json", 0)])
def test_ids_are_the_librarys(spark, texts, name, file, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(file))
    got = sorted(tuple(r) for r in QUERIES[name](spark, SF_DIR).collect())
    want, start = [], 0
    for (i, _), e in zip(texts.items(), library.encode_batch(list(texts.values()), add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, end], dtype="<u4")
        if name == "op4_token_files":
            want.append((i, start, len(ids), crc32(ids.tobytes())))
            start += len(ids)
        else:
            first = len(ids) % 2048 or 2048
            bounds = [0, *range(first, len(ids) + 1, 2048)]
            want += [(i, k, a, b - a, crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    assert [r[: len(want[0])] for r in got] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=1500), st.integers(0, 310))
def test_wavelet_matrix(values, symbol):
    matrix = WaveletMatrix.from_row(WaveletMatrix.build(np.array(values, dtype=np.uint32)).to_row())
    assert matrix.decode().tolist() == values and matrix.count(symbol) == values.count(symbol)
    places = [i for i, v in enumerate(values) if v == symbol]
    for k in range(0, len(values), 97):
        assert matrix.access(k) == values[k] and matrix.rank(symbol, k) == values[:k].count(symbol)
    assert [matrix.select(symbol, k) for k in range(len(places))] == places and matrix.select(symbol, len(places)) == -1


def test_golay_keys_meet_at_one_bit():
    near, away = codeword_keys(16)
    random = np.random.default_rng(1)
    for value in random.integers(0, 1 << 16, 300).tolist():
        for bit in range(16):
            pair = [value, value ^ 1 << bit]
            keys = [{int(near[v]), *(away[v].tolist() if v.bit_count() % 2 else [])} - {-1} for v in pair]
            assert keys[0] & keys[1]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_fingerprints_within_three_bits_share_a_key(value, bits):
    other = value
    for b in bits:
        other ^= 1 << b
    keys, owners = simhash.segment_keys(np.array([value, other], dtype=np.uint64))
    assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


def components(values):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in ordered}


def test_links_of_a_crowd(spark):
    """A dense ball, a chain and strangers, with keys cut into small blocks."""
    random = np.random.default_rng(2)
    centre = int(random.integers(0, 2**63))
    crowd = {centre}
    for _ in range(400):
        v = centre
        for b in random.choice(64, random.integers(1, 5), replace=False):
            v ^= 1 << int(b)
        crowd.add(v)
    chain = [int(random.integers(0, 2**63))]
    for k in range(12):
        chain.append(chain[-1] ^ 7 << 5 * k)
    values = sorted(crowd | set(chain) | {int(v) for v in random.integers(0, 2**63, 200)})
    want = components(values)
    forest = simhash.forest(np.array(values, dtype=np.uint64))
    assert len(forest) == len(values) - len(set(want.values())) and all((a ^ b).bit_count() <= 3 for a, b in forest)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    from scalargrid.llm.components import components as spark_components

    got = {r["node"]: r["root"] for r in spark_components(simhash.fingerprint_links(prints, block=40)).collect()}
    groups = {}
    for v, s in zip(values, signed, strict=True):
        groups.setdefault(want[v], set()).add(s)
    for members in groups.values():
        assert {got.get(s, s) for s in members} == {min(members)}


@tables
def test_near_groups(spark, texts):
    got = run(spark, "op5_simhash_golay")
    prints = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {i: got[i]["fingerprint"] for i in got} == {i: f"{v:016x}" for i, v in prints.items()}
    root = components(set(prints.values()))
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert {i: got[i]["component_id"] for i in got} == {i: first[root[v]] for i, v in prints.items()}


def test_best_fit_respects_every_capacity():
    lengths = np.sort(np.random.default_rng(3).integers(1, 90, 400))[::-1]
    for most, cost in ((1000, 10**9), (3, 10**9), (1000, 4000)):
        bins, offsets = best_fit(lengths, 100, most, cost)
        for b in range(bins.max() + 1):
            own = lengths[bins == b]
            assert own.sum() <= 100 and len(own) <= most and ((own**2).sum() <= cost or len(own) == 1)
            assert sorted(offsets[bins == b]) == np.cumsum([0, *own[np.argsort(offsets[bins == b])]])[:-1].tolist()
    assert best_fit(lengths, 100, 1000, 10**9)[0].max() + 1 <= np.ceil(lengths.sum() / 100) + 3


def test_exponents():
    sizes = {"a": 700, "b": 200, "c": 100, "none": 0}
    assert mixing.bisected(sizes, max_repeats=100) == 0.0 and mixing.weights(sizes, 1)["a"] == pytest.approx(0.7)
    flat = mixing.bisected(sizes, max_repeats=2)
    assert max(mixing.repeats(sizes, flat).values()) == pytest.approx(2) and min(mixing.repeats(sizes, flat).values()) == 1
    even = mixing.bisected(sizes, target_entropy=0.9)
    assert mixing.entropy(sizes, even) == pytest.approx(0.9) and mixing.bisected({}, max_repeats=2) == 0.0


@tables
def test_budgets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows, all_docs = mixing.draws(docs, max_repeats=1.5, blocks=8).collect(), docs.collect()
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in all_docs}
    sums, used = {}, {}
    for r in all_docs:
        sums[r["source"]] = sums.get(r["source"], 0) + size[r["doc_id"]]
    for r in rows:
        used[r["source"]] = used.get(r["source"], 0) + size[r["doc_id"]]
    times = mixing.repeats(sums, mixing.bisected(sums, max_repeats=1.5))
    for s, n in sums.items():
        # A budget is overrun by less than its last document.
        assert times[s] * n - 1e-6 <= used[s] < times[s] * n + max(size.values())
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) and {r["doc_id"] for r in rows if not r["copy"]} == set(size)
    assert mixing.mixed(docs, max_repeats=1.5, blocks=8).count() == len(rows)


def test_ring_is_walked_in_order():
    """The plan on counts gives every shard what walking the ring row by row gives it."""
    owners, counts = [0, 1, 2, 0, 1, 2], [5, 0, 1, 4, 3, 2]
    room = sharding.capacities(sum(counts), 3)
    left, taken = list(counts), [0, 0, 0]
    where = {}
    for step in range(6):
        for arc in range(6):
            for rank in range(counts[arc] - left[arc], counts[arc]):
                shard = owners[(arc + step) % 6]
                if taken[shard] < room[shard]:
                    where[arc, rank] = shard, taken[shard]
                    taken[shard] += 1
                    left[arc] -= 1
    got = {}
    for arc, first, end, shard, slot in sharding.plan(counts, owners, room):
        got |= {(arc, r): (shard, slot + r - first) for r in range(first, end)}
    assert got == where and taken == room


def test_pieces_cover_the_ring():
    points = sharding.ring(4, 8)
    pieces = sharding.stretches(points, 16)
    assert pieces[0][2] == 0 and pieces[-1][3] == (1 << sharding.RING_BITS) - 1
    assert all(a[3] + 1 == b[2] for a, b in zip(pieces, pieces[1:], strict=False))
    for _, _, low, high, arc in pieces:
        owner = next((k for k, (p, _) in enumerate(points) if p >= low), 0)
        assert arc == owner == next((k for k, (p, _) in enumerate(points) if p >= high), 0)


def test_a_shard_more_takes_points_only_into_itself():
    few, more = sharding.ring(4), sharding.ring(5)
    assert set(few) <= set(more) and {s for _, s in set(more) - set(few)} == {4}


def test_gradients():
    network, random = Gru(3, hidden=4, attention=3), np.random.default_rng(0)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    x, y, weight = random.standard_normal((6, 5, 3)), (random.random(5) > 0.5).astype(float), random.random(5) + 0.5
    _, grads, to_words = network.gradients(x, y, weight)
    for at in ((0, 0, 0), (5, 4, 2), (2, 3, 1)):
        moved = [x.copy(), x.copy()]
        moved[0][at] += 1e-3
        moved[1][at] -= 1e-3
        up, down = (network.gradients(m, y, weight)[0] for m in moved)
        assert to_words[at] == pytest.approx((up - down) / 2e-3, abs=2e-5)
    for name, grad in grads.items():
        flat, at = network.weights[name].ravel(), int(random.integers(grad.size))
        flat[at] += 1e-3
        up = network.gradients(x, y, weight)[0]
        flat[at] -= 2e-3
        down = network.gradients(x, y, weight)[0]
        flat[at] += 1e-3
        assert grad.ravel()[at] == pytest.approx((up - down) / 2e-3, abs=2e-5), name


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        starts = toxicity.window_starts(n)
        seen = {s + k for s in starts for k in range(toxicity.WINDOW)}
        assert set(range(n)) <= seen and max(starts) + toxicity.WINDOW <= max(n, toxicity.WINDOW)


def test_long_words_are_read_whole():
    assert "".join(toxicity.words_of("X" * 100 + " don't t0xic_!")) == "x" * 100 + "don'tt0xic_!"


def test_learned_inputs_and_their_gradients():
    words = ["", "a", "t0xic", "don", "'", "x" * 24]
    layer, random = WordInputs().learn(words), np.random.default_rng(2)
    layer.weights = {k: v.astype(np.float64) for k, v in layer.weights.items()}
    assert not layer.vectors()[0].any() and layer.vectors().shape == (6, 12) and len(np.unique(layer.vectors(), axis=0)) == 6
    used, own, out = np.array([0, 2, 5]), np.array([[0, 1], [2, 1], [1, 0]]), random.standard_normal((3, 2, 12))
    grads = layer.gradients(used, own, out)
    for name, grad in grads.items():
        for row, column in zip(*np.nonzero(grad), strict=True):
            at = [(0.0, None), (1e-3, None)]
            values = []
            for step, _ in at:
                layer.weights[name][row, column] += step
                values.append((layer.vectors(used)[own] * out).sum())
            layer.weights[name][row, column] -= 1e-3
            assert grad[row, column] == pytest.approx((values[1] - values[0]) / 1e-3, abs=1e-4)


def test_windows_of_a_long_text_stand_where_those_of_a_short_one_do():
    assert toxicity._CHUNK_WORDS % toxicity.STRIDE == 0
    random = np.random.default_rng(3)
    network, learned = Gru(toxicity.INPUTS), WordInputs()
    evidence = random.standard_normal(toxicity.BUCKETS).astype(np.float32)
    score = toxicity.Model(toxicity.packed(evidence), network.weights, learned.weights).scorer()
    words = [f"w{i}" for i in random.integers(0, 500, 2 * toxicity._CHUNK_WORDS + 1000)]
    whole = float(score([" ".join(words)])[0])
    vocabulary = toxicity.Vocabulary(evidence, learned)
    rows = toxicity.windows(vocabulary.indices(words))
    table = vocabulary.inputs()
    plain = max(float(network.forward(table[rows[at : at + 4096].T]).max()) for at in range(0, len(rows), 4096))
    assert whole == pytest.approx(plain, abs=1e-5)


@tables
def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in toxicity.op8_gru_toxicity(spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(got[i]["predicted"], t) for i, t in labels.items() if got[i]["held_out"]]
    assert np.mean([p for p, t in held if t]) > 0.85 and np.mean([p for p, t in held if not t]) < 0.04
    assert len(got) == 10_000 and all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
