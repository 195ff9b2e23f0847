"""Words of whole texts as numbers, found by Arrow in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import ASCII_UPPER, slices_of

SLICE_BYTES = 3 << 20

LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_UPPER.lower().encode())


@dataclass
class Words:
    """The words of several texts: ``ids`` point into ``dictionary``, ``lengths`` are words a text."""

    dictionary: pa.Array
    ids: np.ndarray
    lengths: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.lengths)])

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.lengths)), self.lengths)


def words_of(texts: pa.Array, table: bytes = LOWER, around: bytes | None = None) -> Words:
    """The words between ASCII white space, after the bytes were replaced by ``table``.

    ``around``: a byte that is a word of its own wherever it stands.
    """
    found: list[bytes] = []
    lengths = []
    for text in texts:
        data = text.as_buffer().to_pybytes().translate(table) if text.is_valid else b""
        if around:
            data = data.replace(around, b" " + around + b" ")
        words = data.split()
        lengths.append(len(words))
        found += words
    coded = pa.array(found, pa.large_binary()).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(coded.dictionary, ids, np.array(lengths, dtype=np.int64))


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of record batches of at most so many bytes in a column, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        for start, end in slices_of(sizes.to_pylist(), most):
            yield batch.slice(start, end - start)


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs (the sum of ``times``)."""
    if times is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    sums = np.add.reduceat(times[order], first) if len(keys) else times
    return keys[first] if len(keys) else keys, sums


def lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Consecutive values as one list a row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
