"""Byte-level BPE ids by the ``tokenizers`` library, each distinct word encoded once per worker.

The pre-tokenizer of these vocabularies never joins what stands on both sides of a space or line
feed between two other characters, nor letters, digits and marks with one another (apostrophes may
be joined), so a text may be cut there and the parts encoded alone. Parts repeat: the cuts are found
on the bytes of a batch at once, Arrow finds the distinct parts, the library encodes those that are
new, and the ids are put back in place. Texts with other white space are cut by an equivalent
expression, and those with a special token's string or a control separator go to the library whole.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tidemark.llm.common import slices_of

VOCABULARY = "byte_bpe_50k.json"
# White space other than single inner spaces and line feeds.
IRREGULAR = (
    r"[ \n][ \n]|^[ \n]|[ \n]$"
    r"|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHOLE = re.compile("[\x1c-\x1f᠎]")
UNITS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
LETTER, DIGIT, MARK = 1, 2, 3
MOST_UNITS = 300_000
WORDS_A_CALL = 300
BLOCK_BYTES = 1 << 18
# Bytes that UTF-8 never holds.
UNUSED_BYTES = [0xC0, 0xC1, *range(0xF5, 0x100)]
SLICE_BYTES = 3 << 20
ENCODED_BYTES = 6 << 20


def _byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself where it is
    printable Latin-1, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {byte: chr(byte) for byte in shown}
    for byte in range(256):
        if byte not in names:
            names[byte] = chr(256 + len(names) - len(shown))
    return names


def _byte_kinds() -> np.ndarray:
    """For each byte whether it is an ASCII letter, digit or mark; 0 for others and the apostrophe."""
    kinds = np.zeros(256, dtype="u1")
    for byte in range(33, 127):
        kinds[byte] = LETTER if chr(byte).isalpha() else DIGIT if chr(byte).isdigit() else MARK
    kinds[ord("'")] = 0
    return kinds


KINDS = _byte_kinds()


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; also of both bytes of the letters U+00C0 to U+00FF (not the signs
    U+00D7 and U+00F7)."""
    kinds = KINDS[data]
    leads = np.flatnonzero(data[:-1] == 0xC3)
    leads = leads[(data[leads + 1] != 0x97) & (data[leads + 1] != 0xB7)]
    kinds[leads] = kinds[leads + 1] = LETTER
    return kinds


def kind_changes(data: np.ndarray) -> np.ndarray:
    """Whether a byte and the one before are letter, digit or mark, but not of one kind."""
    found = np.zeros(len(data), dtype=bool)
    for at in range(0, len(data), BLOCK_BYTES):
        low = max(at - 2, 0)
        kinds = _kinds(data[low : at + BLOCK_BYTES + 1])
        changes = np.zeros(len(kinds), dtype=bool)
        changes[1:] = (kinds[1:] != kinds[:-1]) & (kinds[1:] != 0) & (kinds[:-1] != 0)
        found[at : at + BLOCK_BYTES] = changes[at - low : at - low + BLOCK_BYTES]
    return found


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary column without nulls, and where each value starts and ends."""
    if not len(values):
        return np.zeros(0, "u1"), np.zeros(1, "<i8")
    ends = np.frombuffer(values.buffers()[1], "<i8")[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", "u1")[ends[0] : ends[-1]]
    return data, ends - ends[0]


def _from_flat(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(ends, "<i8")), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


class UnitEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to ``tokenizer.encode``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = _byte_characters()
        self.names = np.array([ord(names[byte]) for byte in range(256)], dtype="<u2")
        self.bare = Tokenizer(self.model)
        # a byte that no merge takes, so that words around it are merged each by itself
        self.between, self.between_id = None, None
        settings = ("ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "dropout")
        if not any(getattr(self.model, name, None) for name in settings):
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            for byte in UNUSED_BYTES:
                if [entry for entry in vocabulary if names[byte] in entry] == [names[byte]]:
                    self.between, self.between_id = byte, vocabulary[names[byte]]
                    break
        self.units = self.ids = pa.array([], pa.large_binary())
        self.used, self.clock = np.zeros(0, dtype="<i8"), 0

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of words of one kind of character each, many in one call of the library."""
        ids = [np.zeros(0, "<u4")]
        for k in range(0, len(words), WORDS_A_CALL):
            some = words.slice(k, WORDS_A_CALL).to_numpy(zero_copy_only=False).tolist()
            joined = np.frombuffer(bytes([self.between]).join([*some, b""]), "u1")
            shown = self.names[joined].tobytes().decode("utf-16-le")
            encoded = self.bare.encode_batch_fast([shown], add_special_tokens=False)
            ids.append(np.array(encoded[0].ids, dtype="<u4"))
        flat = np.concatenate(ids)
        after = np.flatnonzero(flat == self.between_id)
        ends = np.concatenate([[0], after - np.arange(len(after))])
        return _from_flat(flat[flat != self.between_id], 4 * ends)

    def _new(self, units: pa.Array) -> pa.Array:
        """The ids of parts that are not remembered."""
        data, ends = _flat(units)
        other = _kinds(data) == 0
        other[ends[:-1]] &= data[ends[:-1]] != ord(" ")
        is_word = np.full(len(units), self.between is not None)
        is_word[np.searchsorted(ends, np.flatnonzero(other), "right") - 1] = False
        words = self._words(units.filter(pa.array(is_word)))
        others = [self.whole(u.decode()) for u in units.filter(pa.array(~is_word)).to_pylist()]
        order = np.empty(len(units), dtype="<i8")
        order[is_word] = np.arange(len(words))
        order[~is_word] = len(words) + np.arange(len(others))
        return pa.concat_arrays([words, binary_array(others)]).take(pa.array(order))

    def _rows(self, units: pa.Array) -> np.ndarray:
        """Where distinct parts stand among the remembered ones, new ones added.

        The parts used last are kept, in Arrow's columns, so that many take little memory.
        """
        if len(self.units) > MOST_UNITS:
            last = np.sort(np.argsort(self.used, kind="stable")[-MOST_UNITS // 2 :])
            self.units, self.ids = self.units.take(pa.array(last)), self.ids.take(pa.array(last))
            self.used = self.used[last]
        places = pc.index_in(units, value_set=self.units)
        is_new = places.is_null().to_numpy(zero_copy_only=False)
        rows = places.fill_null(0).to_numpy().astype("<i8")
        rows[is_new] = len(self.units) + np.arange(is_new.sum())
        new = units.filter(places.is_null())
        self.units = pa.concat_arrays([self.units, new])
        self.ids = pa.concat_arrays([self.ids, self._new(new)])
        self.clock += 1
        self.used = np.append(self.used, np.zeros(len(new), dtype="<i8"))
        self.used[rows] = self.clock
        return rows

    def _parts(self, texts: pa.Array, odd: dict[int, str]) -> list[bytes]:
        """The ids of texts, encoded in parts; ``odd`` are those with other white space."""
        data, ends = _flat(texts.cast(pa.large_binary()))
        if not len(data):
            return [b""] * len(texts)
        feeds = data == ord("\n")
        starts = feeds | (data == ord(" "))
        starts[1:] |= feeds[:-1]
        for k, text in odd.items():
            lengths = [len(unit.encode()) for unit in UNITS.findall(text)]
            starts[ends[k] : ends[k + 1]] = False
            starts[ends[k] + np.cumsum([0, *lengths[:-1]])] = True
        starts |= kind_changes(data)
        starts[ends[ends < len(data)]] = True
        bounds = np.append(np.flatnonzero(starts), len(data))
        coded = _from_flat(data, bounds).dictionary_encode()
        rows = self._rows(coded.dictionary)[coded.indices.to_numpy()]
        ids, places = _flat(self.ids.take(pa.array(rows)))
        ids, cuts = memoryview(ids), places[np.searchsorted(bounds, ends)].tolist()
        return [bytes(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _slice(self, texts: pa.Array) -> list[bytes]:
        pattern = "|".join([IRREGULAR, *map(re.escape, self.special)])
        is_odd = pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        odd = {k: texts[k].as_py() for k in np.flatnonzero(is_odd).tolist()}
        whole = {
            k: self.whole(text)
            for k, text in odd.items()
            if WHOLE.search(text) or any(s in text for s in self.special)
        }
        if not whole:
            return self._parts(texts, odd)
        cut = [k for k in range(len(texts)) if k not in whole]
        place = {k: n for n, k in enumerate(cut)}
        odd = {place[k]: text for k, text in odd.items() if k in place}
        parts = self._parts(texts.take(pa.array(cut, pa.int64())), odd)
        return [whole[k] if k in whole else parts[place[k]] for k in range(len(texts))]

    def rest(self) -> None:
        """Give back memory at the end of a task: idle workers stay alive for a while."""
        give_back_memory()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        out: list[bytes] = []
        for _, part in by_bytes(texts, ENCODED_BYTES):
            out += self._slice(part)
        return out


def by_bytes(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of a text column of at most so many bytes, or one text; with their start."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for start, end in slices_of(sizes.tolist(), most):
        yield start, texts.slice(start, end - start)


def binary_array(blobs: list[bytes]) -> pa.Array:
    ends = np.zeros(len(blobs) + 1, dtype="<i8")
    np.cumsum(np.fromiter(map(len, blobs), dtype="<i8", count=len(blobs)), out=ends[1:])
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(blobs))]
    return pa.Array.from_buffers(pa.large_binary(), len(blobs), buffers)


def give_back_memory() -> None:
    """Return what the allocators hold but do not use; without effect where libc has no trim."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim:
        trim(0)


_encoders: dict[str, UnitEncoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> UnitEncoder:
    """The worker's encoder for a vocabulary file: a public name, or a path."""
    if vocabulary not in _encoders:
        path = vocabulary
        if "/" not in vocabulary:
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        # a worker has one core: no threads of the library
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[vocabulary] = UnitEncoder(path)
    return _encoders[vocabulary]
