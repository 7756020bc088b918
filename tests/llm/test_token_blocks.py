"""Many texts encoded at once: against the library, and how often chunks are looked up."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scalargrid.llm import token_files
from scalargrid.llm.encoding import ChunkEncoder, encoder
from scalargrid.llm.wavelet import WaveletMatrix
from test_encoding import BITS, SPECIAL, library, public_tokenizers

PATH = public_tokenizers.path("word_bpe_49k.json")
LATIN = [chr(c) for c in range(0x20, 0x180)]


def wanted(text: str | None) -> list[int]:
    return [*library(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def held_against_library(texts: pa.Array) -> None:
    ids, counts = encoder(PATH, False).encode_all(texts, 1)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [wanted(t) for t in texts.to_pylist()]
    assert len(ids) == counts.sum()


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.none() | st.lists(BITS | st.sampled_from(LATIN), max_size=12).map("".join), min_size=1, max_size=8), skip=st.integers(0, 7))
def test_any_texts(texts, skip):
    held_against_library(pa.array(texts, pa.string())[min(skip, len(texts) - 1) :])


@pytest.mark.parametrize("texts", [[None], [""], ["", None, ""], SPECIAL, [SPECIAL[0], None], [f"a {SPECIAL[0]}", "b B", None, *SPECIAL, "c"], ["  \n "]])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_without_chunks_or_with_special_tokens(texts, kind):
    held_against_library(pa.array(texts, kind))


def test_every_plain_character():
    held_against_library(pa.array([f"{c} x{c}y {c.upper()}{c} 1{c}2" for c in LATIN]))


@pytest.mark.parametrize("raw", [b"\xc3a", b"a\x80", b"b \xc3", b"\xff"])
def test_bytes_that_are_no_text_fail(raw):
    texts = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(raw)], dtype="<i4")), pa.py_buffer(raw)])
    with pytest.raises(pa.ArrowInvalid):
        encoder(PATH, False).encode_all(texts, 1)


class Counting(ChunkEncoder):
    looked_up = 0

    def __getitem__(self, chunk):
        Counting.looked_up += 1
        return super().__getitem__(chunk)


def written(monkeypatch, docs: list[tuple[int | None, str | None]], block_tokens: int, batch_rows: int) -> list[dict]:
    """Rows of the blocks of one shard."""
    monkeypatch.setattr(token_files, "encoder", lambda *_: Counting(PATH, False))
    monkeypatch.setattr(token_files.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    batches = pa.table(list(map(list, zip(*docs, strict=True))), schema=schema).to_batches(batch_rows)
    return [r for b in token_files._blocks(PATH, 1, block_tokens)(iter(batches)) for r in b.to_pylist()]


def test_words_that_repeat_are_looked_up_once(monkeypatch):
    words = [f"word{chr(97 + i)}," for i in range(20)]
    Counting.looked_up = 0
    rows = written(monkeypatch, [(i, " ".join(words)) for i in range(500)], 1 << 20, 10_000)
    assert len(rows) == 1 and len(rows[0]["doc_ids"]) == 500
    # 10,000 words of 20 kinds: a look-up a word, and of its two pieces when first met, before.
    assert Counting.looked_up <= 3 * len(words)


@pytest.mark.parametrize("slice_bytes", [1, 40, 1 << 20])
@pytest.mark.parametrize("block_tokens,batch_rows", [(1, 3), (9, 3), (10, 100), (1 << 20, 7)])
def test_blocks_end_with_the_document_that_fills_them(monkeypatch, slice_bytes, block_tokens, batch_rows):
    monkeypatch.setattr(token_files, "SLICE_BYTES", slice_bytes)
    texts = ["one two", None, "Éa 12 " * 9, "", f"x{SPECIAL[0]}y", "three", *(["and so on"] * 6), "it's 中文"]
    want, size = [[]], 0
    for i, text in enumerate(texts):
        if size >= block_tokens:
            want, size = [*want, []], 0
        want[-1].append((i, wanted(text)))
        size += len(want[-1][-1][1])
    rows, start = written(monkeypatch, list(enumerate(texts)), block_tokens, batch_rows), 0
    assert len(rows) == len(want)
    for k, (row, block) in enumerate(zip(rows, want, strict=True)):
        assert (row["shard"], row["block"], row["shard_start"]) == (3, k, start)
        assert list(zip(row["doc_ids"], row["lengths"], strict=True)) == [(i, len(x)) for i, x in block]
        assert WaveletMatrix.from_row(row).decode().tolist() == [t for _, x in block for t in x]
        start += row["n"]
