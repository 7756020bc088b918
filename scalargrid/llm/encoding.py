"""Token ids of whole texts; a chunk of text that comes again is not tokenised again.

A tokenizer that never merges across white space gives the same ids for a text as for its
chunks in turn. Chunks are mostly words with marks and repeat, so each Python worker remembers
their ids. A chunk of common letters, digits and marks is put together from its pieces, which
repeat even more; their ids come from the model of the tokenizer library. Any other chunk goes
whole through the library, and so does a text that holds an added token such as ``<|endoftext|>``.

Texts come one by one (``encode``) or many at once (``encode_all``), which looks up each different piece
of them once and needs no Python object for a chunk.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import islice
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks remembered per Python worker, about 200 bytes each, with half as many pieces.
KEEP_CHUNKS = 900_000
# Longer ones, as in texts without white space, hardly repeat and are not remembered.
LONGEST = 64

# Unicode White_Space, as the tokenizers' own patterns understand \s.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# A space goes with the word behind it; of a longer run of white space the last character stays apart.
_SPACED = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r'!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~'
_PLAIN = re.compile(f" ?[{_LETTERS}0-9{_MARKS}]+")
# Byte-level models read bytes as printable characters: all outside these ranges are numbered from 256.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_id = attrgetter("id")


def _halve(known: dict) -> None:
    """Forget the later half; what came first comes most often."""
    first = dict(islice(known.items(), len(known) // 2))
    known.clear()
    known.update(first)


# What the bytes of a plain chunk belong to: letters, of which those beyond ASCII begin with 0xC3, digits or marks; 0 if it is not plain.
_ACCENT, _DIGIT = 0xC3, 2
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 192), _ACCENT]] = 1
_KINDS[48:58] = _DIGIT
_KINDS[[b for b in range(33, 127) if not _KINDS[b] and chr(b) != "'"]] = 3
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


def _pieces(chunks: pa.LargeStringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-cased pieces of plain chunks and all others as they are, equal ones numbered, and where those of each chunk begin and end."""
    offsets = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset :][: len(chunks) + 1]
    size = int(offsets[-1] - offsets[0])
    raw = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kinds = _KINDS[raw]
    accented = np.flatnonzero(raw[:-1] == _ACCENT) + 1
    kinds[accented[np.isin(raw[accented], [0x97, 0xB7])]] = 0  # signs of multiplication and division
    odd = np.zeros(len(chunks), dtype=bool)
    odd[np.searchsorted(offsets, np.flatnonzero(kinds == 0), side="right") - 1] = True
    apart = np.repeat(odd, np.diff(offsets))
    first = np.ones(size, dtype=bool)
    first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    first &= ~apart
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    low = _LOWER[raw]
    low[accented] += np.where(raw[accented] < 0x9F, 32, 0).astype(np.uint8)
    begins = np.append(np.flatnonzero(first), size)
    data = [None, pa.py_buffer(begins), pa.py_buffer(np.where(apart, raw, low))]
    pieces = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, data).dictionary_encode()
    return pieces, np.append(0, np.cumsum(first))[offsets]


def _joined(entries: pa.LargeBinaryArray, index: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """The chosen entries one behind the other, and where each begins and ends."""
    taken = entries.take(index)
    assert taken.offset == 0
    return np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(taken) + 1], taken.buffers()[2] or pa.py_buffer(b"")


class ChunkEncoder(dict):
    """Texts to little-endian unsigned 32-bit ids, with ``keep`` chunks and half as many pieces remembered at most.

    ``spaced``: byte-level vocabularies keep white space, and a space belongs to the piece
    behind it. Otherwise white space only separates, and letters are lower-cased.
    """

    def __init__(self, path: str, spaced: bool, keep: int = KEEP_CHUNKS) -> None:
        from tokenizers import Tokenizer

        assert array("I").itemsize == 4
        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added]
        self._whole = any(t.normalized for t in added)  # such tokens may stand in a text in other forms
        self._spaced, self._keep = spaced, keep + keep // 2
        self._model = self._tokenizer.model
        self._split = re.compile(
            f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+" if spaced else f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+"
        ).findall

    def __missing__(self, chunk: str) -> bytes:
        # A piece is a chunk as well: one that is a piece of itself goes to the model.
        if chunk.isascii() and chunk.isalpha():
            ids = self._by_model(chunk)
        elif _PLAIN.fullmatch(chunk):
            pieces = self._split(chunk)
            ids = self._by_model(chunk) if pieces == [chunk] else b"".join(map(self.__getitem__, pieces))
        else:
            ids = self._by_library(chunk)
        if len(chunk) > LONGEST:
            return ids
        if len(self) >= self._keep:
            _halve(self)
        self[chunk] = ids
        return ids

    def _by_model(self, piece: str) -> bytes:
        text = piece if self._spaced else piece.lower()
        if not (text.isascii() and text.isprintable()) or " " in text:
            text = text.encode().decode("latin-1").translate(_SHOWN)
        return array("I", map(_id, self._model.tokenize(text))).tobytes()

    def _by_library(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if self._whole or any(content in text for content in self._added):
            return self._by_library(text)
        chunks = _SPACED.findall(text) if self._spaced else text.replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, chunks))

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, an end id behind each text, and how many ids each has with it; NULL is empty.

        For vocabularies in which white space only separates. Arrow cuts the texts into chunks, and each
        different chunk into pieces; each different piece is looked up once.
        """
        assert not self._spaced
        texts = texts.cast(pa.large_string())
        texts.validate(full=True)  # fails if a text is no UTF-8, as ``encode`` does; bytes are cut by what they would mean
        alone = np.full(len(texts), self._whole)
        for content in self._added:
            alone |= pc.match_substring(texts, content).fill_null(False).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~alone)), "\n", " "), " ")
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[~alone] = pc.list_value_length(cut).fill_null(0).to_numpy()
        chunks = cut.flatten().dictionary_encode()
        pieces, bounds = _pieces(chunks.dictionary)
        known = map(self.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False))
        offsets, ids = _joined(pa.array(known, pa.large_binary()), pieces.indices)
        entries = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets[bounds]), ids])
        # Behind the chunks of a text come its ids, if it went whole through the library, and the end id.
        owners = np.flatnonzero(alone)
        more = [array("I", [end_id]).tobytes(), *(self._by_library(texts[i].as_py() or "") for i in owners.tolist())]
        values = np.concatenate([np.arange(1, len(more)), np.zeros(len(texts), dtype=np.int64)]) + len(entries)
        owners = np.concatenate([owners, np.arange(len(texts))])
        order = np.argsort(owners, kind="stable")
        index = np.insert(chunks.indices.to_numpy(), np.cumsum(counts)[owners[order]], values[order])
        offsets, ids = _joined(pa.concat_arrays([entries, pa.array(more, pa.large_binary())]), pa.array(index))
        reach = offsets[np.cumsum(counts + alone + 1)] // 4
        return np.frombuffer(ids, dtype="<u4", count=offsets[-1] // 4), np.diff(reach, prepend=0)


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool, keep: int = KEEP_CHUNKS) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary."""
    return ChunkEncoder(path, spaced, keep)


def give_back() -> None:
    """Give back memory of Arrow batches that are gone; Arrow would keep it, in a worker that outlives the stage."""
    pa.default_memory_pool().release_unused()


def forget() -> None:
    """Give back what this Python worker remembers; workers outlive a stage, and the next one may need the memory."""
    encoder.cache_clear()
    give_back()
