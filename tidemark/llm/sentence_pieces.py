"""SentencePiece encoding and decoding as a max-plus parallel scan.

The segmentation of a text is the path of greatest total piece score (the unigram rule) over the
vocabulary of a public SentencePiece model; characters without a piece of their own are written as
byte pieces. Pieces are at most ``reach`` characters long, so at a border the only thing that matters
is how far the piece across it goes: a state from 0 to reach - 1.

Texts above ``GIANT_CHARS`` are cut into chunks. A chunk gives a transfer matrix: entry (i, j) is the
best score from a cut i characters behind its start to a cut j characters behind its end, with the place
of that path among those that reach j. Matrices combine by (max, +), which is associative: blocks of
chunks are combined in parallel, the border states of the blocks are found per document from the block
matrices, then those of the chunks inside each block, and each chunk is traced back on its own between
its two states. Where no piece can reach over the start of a word, a matrix is the sum of a column and a
row, found from the two ends of the chunk.

Of equal totals the path with the longer last piece wins, then the longer piece before it, and so on. The
places carry this rule over the borders, so the ids depend neither on ``GIANT_CHARS`` nor on the chunks.

All texts are segmented unit by unit: two characters that no piece holds side by side are always cut apart, as
are a letter and a full stop, or whatever stands before a space. A table of byte pairs tells these places of
a part of the texts at once; Arrow finds the distinct units, and each is segmented once per worker: all new
units of one length together, as columns of characters that walk down a table of the pieces.
Documents are read once; ids of plain texts and the chunks of giant ones are stored with a row number.

The model file is one of BPE type, whose scores are ranks and whose merges are no path of greatest score.
Its pieces are used under the unigram rule instead, which is what this scan computes, with the log
probabilities that Zipf's law gives to their ranks. The result is what the library finds for a file of
unigram type with these scores (its n-best search; tests compare).

Defined cases: very long texts are cut in one pass, and their ids come together in one row of at most
2 GB; a null or empty text has no pieces and decodes to the empty text; the space mark U+2581
in a text is read as a space, as in the library; repeated rows and null doc_ids are rows like others; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import binary_array, by_bytes, give_back_memory
from tidemark.llm.common import bounded_batches, bounded_bytes, row_id, slices_of, stored, text_of

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# A mark as one byte, which UTF-8 does not use.
MARK_BYTE = b"\xff"
GIANT_CHARS = 32_768
CHUNK_CHARS = 8_192
CHUNKS_PER_BLOCK = 64
MOST_WORDS = 150_000
DECODE_BYTES = 4 << 20
UNKNOWN_PENALTY = 10.0
ALPHABET = 128
LONGEST_WORD = 48
WORDS_AT_ONCE = 16_384
# Fewer words of one length are traced one by one.
FEW_WORDS = 16
NEVER = -np.inf


def piece_score(file_score: float) -> float:
    """Ten thousand times the log probability, up to a constant, of a piece of rank -file_score.

    Whole numbers, so that sums are exact and equal in any order.
    """
    return -float(round(10_000 * math.log1p(-file_score)))


class PieceModel:
    """Pieces, scores and the best-path search of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        shown = [library.id_to_piece(k).encode().replace(MARK.encode(), b" ") for k in ids]
        self.byte_ids = [0] * 256
        self.pieces: dict[str, tuple[float, int]] = {}
        for k in ids:
            if library.is_byte(k):
                value = int(library.id_to_piece(k)[3:5], 16)
                self.byte_ids[value], shown[k] = k, bytes([value])
            elif library.is_control(k) or library.is_unknown(k):
                shown[k] = b""
            elif not library.is_unused(k):
                self.pieces[library.id_to_piece(k)] = (piece_score(library.get_score(k)), k)
        self.shown = binary_array(shown)
        self.unknown = min(score for score, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.reach = max(map(len, self.pieces))
        # words are independent if the mark stands only in front of pieces
        self.marks_lead = all(MARK not in piece.lstrip(MARK) for piece in self.pieces)
        # what pieces start with: the score of what is a piece; single characters are never dead ends
        self.beginnings = {p[:k]: NEVER for p in self.pieces for k in range(2, len(p))}
        self.beginnings |= {p[0]: self.unknown for p in self.pieces}
        self.beginnings |= {p: score for p, (score, _) in self.pieces.items()}
        self.numbers = {p: number for p, (_, number) in self.pieces.items()}
        self.joined = joined_bytes(self.pieces)
        self.table = PieceTable(self.pieces, self.unknown)
        self.words: dict[str, tuple[float, bytes]] = {}
        self.older_words: dict[str, tuple[float, bytes]] = {}

    def forward(self, text: str, start: int, stop: int) -> tuple[list[float], list[int]]:
        """Best scores of cuts from ``start``, with pieces that begin before ``stop``.

        With each cut goes the start of the piece in front of it, the longest of equals.
        """
        n, begins, unknown = len(text), self.beginnings.get, self.unknown
        score: list[float] = [NEVER] * (n + 1)
        last = [0] * (n + 1)
        score[start] = 0.0
        for at in range(start, min(stop, n)):
            so_far = score[at]
            if so_far == NEVER:
                continue
            for end in range(at + 1, n + 1):
                value = begins(text[at:end])
                if value is None:
                    if end == at + 1 and so_far + unknown > score[end]:
                        score[end], last[end] = so_far + unknown, at
                    break
                value += so_far
                if value > score[end]:
                    score[end], last[end] = value, at
        return score, last

    def traced(self, text: str) -> tuple[float, bytes]:
        """Score and ids of the best path over a word."""
        score, last = self.forward(text, 0, len(text))
        numbers = self.numbers
        ids: list[int] = []
        end = len(text)
        while end:
            start = last[end]
            number = numbers.get(text[start:end])
            if number is None:
                ids += [self.byte_ids[b] for b in reversed(text[start:end].encode())]
            else:
                ids.append(number)
            end = start
        ids.reverse()
        return score[len(text)], array("I", ids).tobytes()

    def units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """What every path cuts apart: the distinct units, which of them follow one another, and how
        many stand before each text. Texts are UTF-8 without nulls, marks may be ``MARK_BYTE``."""
        texts = pc.replace_substring(texts.cast(pa.large_binary()), MARK.encode(), MARK_BYTE)
        ends = np.zeros(1, np.int64)
        if len(texts):
            ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset :][: len(texts) + 1]
        if ends[-1] == ends[0]:
            return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        cut = ~self.joined[data[:-1].astype(np.uint16) << 8 | data[1:]]
        cut[ends[(ends > 0) & (ends < len(data))] - 1] = True
        bounds = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(data)]]).astype("<i8")
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
        distinct = pc.replace_substring(coded.dictionary, MARK_BYTE, MARK.encode()).cast(pa.large_string())
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        return distinct.to_numpy(zero_copy_only=False).tolist(), numbers, np.searchsorted(bounds, ends)

    def found(self, units: list[str]) -> list[tuple[float, bytes]]:
        """Score and ids of distinct units; two generations of remembered units bound the memory."""
        if len(self.words) >= MOST_WORDS:
            self.older_words, self.words = self.words, {}
        known, older = self.words, self.older_words
        out = list(map(known.get, units))
        missing = [k for k, found in enumerate(out) if found is None]
        new = []
        for k in missing:
            unit = units[k]
            if unit in older:
                known[unit] = older[unit]
            else:
                new.append(unit)
        known.update(self.table.traced(new))
        for unit in new:
            if unit not in known:
                known[unit] = self.traced(unit)
        for k in missing:
            out[k] = known[units[k]]
        return out

    def ids(self, marked: str) -> bytes:
        """The ids of a text whose spaces are marks, as unsigned 32-bit bytes."""
        return self.ids_of_marked(pa.array([marked], pa.large_string()))[0]

    def score(self, marked: str) -> float:
        """The score of the best path over whole words."""
        distinct, numbers, _ = self.units(pa.array([marked], pa.large_string()))
        return float(np.array([score for score, _ in self.found(distinct)])[numbers].sum())

    def ids_of_marked(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without nulls whose spaces are marks."""
        distinct, numbers, starts = self.units(texts)
        placed = binary_array([ids for _, ids in self.found(distinct)]).take(pa.array(numbers))
        return pieces_between(placed, starts)

    def ids_of_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without nulls, spaces not yet marked."""
        texts = texts.cast(pa.large_binary())
        mark, nothing = (pa.scalar(c, pa.large_binary()) for c in (MARK_BYTE, b""))
        marked = pc.binary_join_element_wise(mark, pc.replace_substring(texts, b" ", MARK_BYTE), nothing)
        return self.ids_of_marked(pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, marked))

    def word_starts(self, text: str) -> list[int]:
        """Positions that every path must cut: the starts of words."""
        if not self.marks_lead:
            return []
        return [m.start() for m in STARTS.finditer(text)]

    def paths(self, text: str, stop: int, ends: list[int]) -> np.ndarray:
        """Score and place of the best path from each state to each of the ends.

        The place of a path is its rank, 0 for the first to take, among the paths to the same end:
        of two, from the right, the one whose next cut is further left, or left of the chunk.
        """
        reach = self.reach
        out = np.full((2, reach, len(ends)), NEVER)
        out[1] = reach
        cuts: list[list[list[int]]] = [[] for _ in ends]
        for i in range(min(reach, len(text) + 1)):
            score, last = self.forward(text, i, stop)
            for j, end in enumerate(ends):
                path: list[int] = []
                if end < len(score) and score[end] > NEVER:
                    out[0, i, j] = score[end]
                    at = end
                    while at != i:
                        path.append(at)
                        at = last[at]
                    path += [i, -1]
                cuts[j].append(path)
        for j, paths in enumerate(cuts):
            for rank, i in enumerate(sorted((i for i, p in enumerate(paths) if p), key=paths.__getitem__)):
                out[1, i, j] = rank
        return out

    def matrix(self, text: str, size: int, is_last: bool) -> np.ndarray:
        """Transfer matrix of a chunk of ``size`` characters; ``text`` goes on behind its end.

        Scores, then places. A chunk that is not the last is as long as the longest piece.
        """
        reach = self.reach
        ends = [size + j for j in range(1 if is_last else reach)]
        out = np.full((2, reach, reach), NEVER)
        out[1] = reach
        starts = self.word_starts(text)
        head = next((s for s in starts if s >= reach - 1), None)
        tail = next((s for s in reversed(starts) if s <= size), None)
        if head is None or tail is None or tail < head:
            out[:, :, : len(ends)] = self.paths(text, size, ends)
            return out
        column, places = self.paths(text[:head], head, [head])
        middle = self.score(text[head:tail])
        score, _ = self.forward(text[tail:], 0, size - tail)
        row = np.full(reach, NEVER)
        for j, end in enumerate(ends):
            if end - tail < len(score):
                row[j] = score[end - tail]
        out[0] = column + (middle + row)[None, :]
        out[1] = places
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; the space that encoding puts in front is taken away."""
        shown = self.shown.take(pa.array(ids))
        return self.plain(pieces_between(shown, np.array([0, len(ids)]))[0])

    def plain(self, shown: bytes) -> str:
        text = shown.decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, blobs: list[bytes]) -> list[str]:
        """The texts of several rows of ids."""
        ids = pa.array(np.frombuffer(b"".join(blobs), dtype="<u4"))
        starts = np.cumsum([0] + [len(blob) // 4 for blob in blobs])
        return list(map(self.plain, pieces_between(self.shown.take(ids), starts)))


class PieceTable:
    """The pieces as a table (beginning, character) -> beginning, walked by many words at a time.

    It knows the ``ALPHABET`` most common characters of the pieces and gives no result for words with
    others, with unknown characters or of more than ``LONGEST_WORD``, nor for ``FEW_WORDS``.
    """

    def __init__(self, pieces: dict[str, tuple[float, int]], unknown: float):
        common = Counter(c for piece in pieces for c in piece).most_common(ALPHABET - 1)
        self.codes = np.zeros(0x110000, np.uint8)
        self.codes[[ord(c) for c, _ in common]] = np.arange(1, len(common) + 1)
        pieces = {p: found for p, found in pieces.items() if self.coded([p]).all()}
        begins = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)}, key=len)
        places = {"": 1} | {text: k for k, text in enumerate(begins, 2)}  # 0: no piece begins so
        self.next = np.zeros((len(places) + 1, ALPHABET), np.int32)
        self.score = np.full(len(places) + 1, NEVER)
        self.number = np.full(len(places) + 1, -1, np.int32)
        for text in begins:
            place = places[text]
            self.next[places[text[:-1]], self.codes[ord(text[-1])]] = place
            if text in pieces:
                self.score[place], self.number[place] = pieces[text]
        self.unknown = unknown

    def coded(self, words: list[str]) -> np.ndarray:
        """The characters of words of one length as codes, 0 for others."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        return self.codes[points].reshape(len(words), -1)

    def traced(self, words: list[str]) -> Iterator[tuple[str, tuple[float, bytes]]]:
        """Words with their score and ids, as ``PieceModel.traced`` finds them."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        for n, alike in by_length.items():
            if 0 < n <= LONGEST_WORD and len(alike) >= FEW_WORDS:
                for at in range(0, len(alike), WORDS_AT_ONCE):
                    yield from self._alike(alike[at : at + WORDS_AT_ONCE], n)

    def _alike(self, words: list[str], n: int) -> Iterator[tuple[str, tuple[float, bytes]]]:
        codes = np.ascontiguousarray(self.coded(words).T)
        score = np.full((n + 1, len(words)), NEVER)
        last = np.zeros((n + 1, len(words)), np.int32)
        piece = np.full((n + 1, len(words)), -1, np.int32)
        score[0] = 0.0
        for at in range(n):
            place = np.ones(len(words), np.int32)
            for end in range(at + 1, n + 1):
                place = self.next[place, codes[end - 1]]
                value = self.score[place]
                if end == at + 1:
                    value = np.where(value > NEVER, value, self.unknown)
                elif not place.any():
                    break
                value = value + score[at]
                better = value > score[end]
                np.copyto(score[end], value, where=better)
                np.copyto(last[end], at, where=better)
                np.copyto(piece[end], self.number[place], where=better)
        ids = np.zeros((len(words), n), np.uint32)
        left = np.full(len(words), n)  # ids fill their row from the right
        end, every = np.full(len(words), n), np.arange(len(words))
        good = codes.all(axis=0)
        while len(every):
            number = piece[end, every]
            good[every] &= number >= 0
            left[every] -= 1
            ids[every, left[every]] = number
            end = last[end, every]
            every, end = every[end > 0], end[end > 0]
        blob, scores, starts = ids.tobytes(), score[n].tolist(), left.tolist()
        for k in np.flatnonzero(good).tolist():
            yield words[k], (scores[k], blob[4 * (n * k + starts[k]) : 4 * n * (k + 1)])


def joined_bytes(pieces: Iterable[str]) -> np.ndarray:
    """For two bytes, as one number: whether a path may not always be cut between them.

    That is, whether they are the last and the first of two characters that some piece holds side by side, or
    may be of one character. Marks are ``MARK_BYTE`` here.
    """
    joined = np.zeros((256, 256), dtype=bool)
    joined[:, 0x80:0xC0] = True
    for pair in {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}:
        one, other = (MARK_BYTE if c == MARK else c.encode() for c in pair)
        joined[one[-1], other[0]] = True
    return joined.reshape(-1)


def marked(text: str) -> str:
    """A text as the pieces see it: a mark in front and in place of spaces."""
    return MARK + text.replace(" ", MARK) if text else ""


def pieces_between(blobs: pa.Array, starts: np.ndarray) -> list[bytes]:
    """The bytes of consecutive runs of ``blobs`` (large binary), joined run by run."""
    if not len(blobs):
        return [b""] * (len(starts) - 1)
    ends = np.frombuffer(blobs.buffers()[1], "<i8")[blobs.offset :]
    data = memoryview(blobs.buffers()[2] or b"")
    bounds = ends[starts]
    return [bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


STARTS = re.compile(f"(?<=[^{MARK}]){MARK}")
_models: dict[str, PieceModel] = {}


def model(name: str = MODEL) -> PieceModel:
    """The worker's model: a public name, or a path."""
    if name not in _models:
        path = name
        if "/" not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _models[name] = PieceModel(path)
    return _models[name]


def combine(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The (max, +) product of two transfer matrices; of equal sums the first place in the right one."""
    sums = one[0][:, :, None] + other[0][None, :, :]
    best = sums.max(axis=1)
    places = np.where(sums == best[:, None, :], other[1][None, :, :], np.inf)
    middle = places.argmin(axis=1)
    right = np.take_along_axis(other[1], middle, axis=0)
    left = np.take_along_axis(one[1], middle, axis=1)
    keys = right * (len(best) + 1) + left
    return np.stack([best, keys.argsort(axis=0, kind="stable").argsort(axis=0).astype(float)])


def combine_all(matrices: list[np.ndarray]) -> np.ndarray:
    """The product of consecutive matrices, pair by pair."""
    while len(matrices) > 1:
        pairs = [combine(a, b) for a, b in zip(matrices[::2], matrices[1::2], strict=False)]
        matrices = pairs + ([matrices[-1]] if len(matrices) % 2 else [])
    return matrices[0]


def border_states(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """States of a best path at all borders of consecutive matrices, given the outer two."""
    reached = [np.full(matrices[0].shape[1], NEVER)]
    reached[0][first] = 0.0
    for matrix in matrices[:-1]:
        reached.append((reached[-1][:, None] + matrix[0]).max(axis=0))
    states = [last]
    for matrix, vector in zip(reversed(matrices), reversed(reached), strict=True):
        sums = vector + matrix[0][:, states[-1]]
        places = np.where(sums == sums.max(), matrix[1][:, states[-1]], np.inf)
        states.append(int(np.argmin(places)))
    return states[::-1]


STORED = (
    "row long, doc_id long, ids binary, block int, chunk int, size int, text string, matrix binary"
)


def _encode_rows(name: str, giant_chars: int, chunk_chars: int):
    """Ids of plain texts, and chunks with their matrices of giant ones, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(name)
        for batch in batches:
            for start, texts in by_bytes(batch.column("text")):
                part = batch.slice(start, len(texts))
                giant = pc.greater_equal(pc.utf8_length(texts), giant_chars)
                yield _plain_rows(pieces, part.filter(pc.invert(giant)))
                yield from _chunk_rows(pieces, part.filter(giant), chunk_chars)
        give_back_memory()

    return run


def _plain_rows(pieces: PieceModel, rows: pa.RecordBatch) -> pa.RecordBatch:
    ids = pieces.ids_of_all(rows.column("text"))
    none = [pa.nulls(rows.num_rows, kind) for kind in (*[pa.int32()] * 3, pa.string(), pa.binary())]
    return pa.RecordBatch.from_arrays(
        [rows.column("row"), rows.column("doc_id"), pa.array(ids, pa.binary()), *none],
        names=STORED_NAMES,
    )


def _chunk_rows(
    pieces: PieceModel, rows: pa.RecordBatch, chunk_chars: int
) -> Iterator[pa.RecordBatch]:
    for row, doc_id, text in zip(*[column.to_pylist() for column in rows.columns], strict=True):
        whole = marked(text)
        starts = range(0, len(whole), chunk_chars)
        for block in range(0, len(starts), CHUNKS_PER_BLOCK):
            found = []
            last = min(block + CHUNKS_PER_BLOCK, len(starts)) * chunk_chars
            pieces.found(pieces.units(pa.array([whole[starts[block] : last]]))[0])
            for at in starts[block : block + CHUNKS_PER_BLOCK]:
                size = min(chunk_chars, len(whole) - at)
                shown = whole[at : at + size + pieces.reach]
                matrix = pieces.matrix(shown, size, at + size == len(whole)).tobytes()
                place = (block // CHUNKS_PER_BLOCK, at // chunk_chars)
                found.append((row, doc_id, None, *place, size, shown, matrix))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found, strict=True), STORED_KINDS, strict=True)],
                names=STORED_NAMES,
            )


STORED_NAMES = [field.split()[0] for field in STORED.split(", ")]
STORED_KINDS = [
    {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}[
        field.split()[1]
    ]
    for field in STORED.split(", ")
]


def _square(blob: bytes) -> np.ndarray:
    matrix = np.frombuffer(blob, dtype=np.float64)
    return matrix.reshape(2, int((len(matrix) // 2) ** 0.5), -1)


def _block_matrix(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values("chunk")
    product = combine_all([_square(blob) for blob in ordered["matrix"]])
    return ordered[["row", "block"]].head(1).assign(matrix=product.tobytes())


def _block_states(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values("block")
    states = border_states([_square(blob) for blob in ordered["matrix"]], 0, 0)
    return ordered[["row", "block"]].assign(first=states[:-1], last=states[1:])


def _chunk_states(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values("chunk")
    states = border_states(
        [_square(blob) for blob in ordered["matrix"]],
        int(ordered["first"].iloc[0]),
        int(ordered["last"].iloc[0]),
    )
    return ordered[["row", "chunk"]].assign(first=states[:-1], last=states[1:])


def _trace_chunks(name: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = model(name)
        for frame in frames:
            rows = zip(frame["text"], frame["size"], frame["first"], frame["last"], strict=True)
            spans = pa.array([text[a : size + b] for text, size, a, b in rows], pa.large_string())
            ids = [own for _, part in by_bytes(spans) for own in pieces.ids_of_marked(part)]
            yield frame[["row", "doc_id", "chunk"]].assign(ids=ids)

    return run


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ids = [b"".join(part["ids"] for part in parts) for parts in frame["parts"]]
        yield frame[["row", "doc_id"]].assign(ids=ids)


def _giant(chunks: DataFrame, name: str) -> DataFrame:
    """The parallel scan over the chunks of long texts; ids by document."""
    matrices = chunks.select("row", "block", "chunk", "matrix")
    blocks = matrices.groupBy("row", "block").applyInPandas(
        _block_matrix, "row long, block int, matrix binary"
    )
    borders = blocks.groupBy("row").applyInPandas(
        _block_states, "row long, block int, first int, last int"
    )
    states = (
        matrices.join(borders, ["row", "block"])
        .groupBy("row", "block")
        .applyInPandas(_chunk_states, "row long, chunk int, first int, last int")
    )
    traced = (
        chunks.select("row", "doc_id", "chunk", "size", "text")
        .join(states, ["row", "chunk"])
        .mapInPandas(_trace_chunks(name), "row long, doc_id long, chunk int, ids binary")
    )
    parts = traced.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"),
    )
    return parts.mapInPandas(_joined, "row long, doc_id long, ids binary")


def encode(
    docs: DataFrame,
    name: str = MODEL,
    giant_chars: int = GIANT_CHARS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """row, doc_id and ids (unsigned 32-bit bytes) of every document (doc_id, text)."""
    if chunk_chars < model(name).reach:
        raise ValueError("a chunk must be as long as the longest piece")
    bounded_batches(docs.sparkSession)
    bounded_bytes(docs.sparkSession)
    rows = docs.select(
        row_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    found = stored(rows.mapInArrow(_encode_rows(name, giant_chars, chunk_chars), STORED), "pieces")
    plain = found.filter(F.col("chunk").isNull()).select("row", "doc_id", "ids")
    return plain.unionByName(_giant(found.filter(F.col("chunk").isNotNull()), name))


def decode(encoded: DataFrame, name: str = MODEL) -> DataFrame:
    """row, doc_id, n_pieces, ids_crc32 and the decoded text of encoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(name)
        for batch in batches:
            blobs = batch.column("ids").to_pylist()
            texts = [
                text
                for a, b in slices_of([len(blob) for blob in blobs], DECODE_BYTES)
                for text in pieces.decode_all(blobs[a:b])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array([len(blob) // 4 for blob in blobs], pa.int64()),
                    pa.array([zlib.crc32(blob) for blob in blobs], pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["row", "doc_id", "n_pieces", "ids_crc32", "text"],
            )
        give_back_memory()

    return encoded.select("row", "doc_id", "ids").mapInArrow(
        run, "row long, doc_id long, n_pieces long, ids_crc32 long, text string"
    )


def round_trip(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, and length and digest of the text that decoding gives back."""
    return decode(encode(docs, name), name).select(
        "doc_id",
        "n_pieces",
        "ids_crc32",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
