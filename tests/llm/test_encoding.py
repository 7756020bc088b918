"""The encoder that remembers chunks against the tokenizer library."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scalargrid.llm.encoding import encoder

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
SPECIAL = ["<|endoftext|>", "<|startoftext|>"]


@lru_cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def ids_of(file: str, spaced: bool, text: str) -> tuple[list[int], list[int]]:
    path = public_tokenizers.path(file)
    want = library(path).encode(text, add_special_tokens=False).ids
    return np.frombuffer(encoder(path, spaced).encode(text), dtype="<u4").tolist(), want


@pytest.mark.parametrize("file,spaced", FILES)
@pytest.mark.parametrize("form", ["{}", "a sample {} next", "a{}b", "x {}  {} y", "\n{}\n", "{}{}", "<{}>", "it's {}'s"])
@pytest.mark.parametrize("token", [*SPECIAL, SPECIAL[0].upper(), "<|endof text|>"])
def test_texts_with_special_tokens(file, spaced, form, token):
    got, want = ids_of(file, spaced, form.replace("{}", token))
    assert got == want


BITS = st.one_of(
    st.text(max_size=6),
    st.sampled_from([*SPECIAL, "'s", "'LL", "it's", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b",
                     "e\u0301", "\u0301", "İ", "ß", "ÀÉ", "½", "٣", "😀", "中文", "12 345", "a_b", "<|", "|>", "don't", "...", "×÷"]),
)


@pytest.mark.parametrize("file,spaced", FILES)
@settings(max_examples=300, deadline=None)
@given(bits=st.lists(BITS, max_size=12))
def test_any_text(file, spaced, bits):
    got, want = ids_of(file, spaced, "".join(bits))
    assert got == want
