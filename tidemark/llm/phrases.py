"""Phrase collocations from an FM-index over word ids in every shard.

A shard is a run of documents of about ``SHARD_BYTES`` of text. Its pieces (texts cut at the marks of the
contract) stand one behind the other as word ids, each piece followed by the mark 0. The shard holds two
Burrows-Wheeler transforms, of the sequence and of its reverse, over rotations sorted by their first
``LONGEST`` words: enough for patterns up to that length. A phrase is a pair of intervals of equal size, one in
each; the reverse transform lists the words that follow it and the forward one those that precede it, with
counts, and a step to any of them gives the pair of intervals of the longer phrase. The interval on the other
side is found by adding up the counts of the smaller words, as neighbours stand in the order of words.

Phrases are enumerated by length, words being added on the right and on the left in turn, for all intervals
of a shard at once, and only from phrases that may be frequent: a longer phrase is never more frequent than
its parts, so none is lost. The frequent words are numbered, and so are the frequent phrases of each length. A
likely phrase has an exact code, of the number of the part that it extends and that of the added word; codes
are counted length by length over all shards, a few bytes each, and the frequent ones are spelled out once,
from their codes. The frequent words and codes are broadcast while they have ``BROADCAST_BYTES`` or less a
length; beyond that each shard is sent, length by length, the frequent phrases among those that it has itself
reported. Both ways give the same counts.

``collocations`` then cuts each phrase in two at the place of the lowest score
floor(1000 f n / (f(first part) f(rest))), in decimals that hold the products, and drops phrases that lie in a
longer one just as frequent. It is enough to look at phrases longer by one word, as what lies between a
phrase and a longer one of the same count has that count too.

Defined cases: a null text counts as empty and a null lang as ``und``; empty pieces have no words; repeated
rows count each; ties rank by frequency, then by the phrase's bytes; an empty table gives no rows; other
columns are ignored. A text is in one shard whole, with about 100 bytes a word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import give_back_memory
from tidemark.llm.common import bounded_batches, bounded_bytes, row_id, stored, text_of
from tidemark.llm.words import LOWER, by_bytes, counted, lists, words_of

LEAST = 100
LONGEST = 5
TOP = 2000
SHARD_BYTES = 1 << 20
# A reader holds a whole row group, a column's page and an Arrow batch at once, beside the Python workers.
BATCH_BYTES = 4 << 20
ROW_GROUPS = {
    "parquet.block.row.count.limit": "4",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}
BROADCAST_BYTES = 64 << 20
SEGMENT_WORDS = 1 << 20
MERGED_CODES = 1 << 20
MOST_LANGS = 10_000
NO_LANG = "und"
# Pieces end at these bytes; no byte of UTF-8 text is 0xff, which stands for them.
END = b"\xff"
PIECE_BYTES = LOWER.translate(
    bytes(
        0xFF if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
    )
)

# Words stand in one binary with a space behind each; numbers are little-endian, ``size`` of them in a transform.
SHARD = (
    "shard long, langs array<binary>, lang_of binary, words binary, counts binary,"
    " size long, forward binary, backward binary"
)


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs."""
    return values.astype(f"<u{np.min_scalar_type(int(values.max(initial=0))).itemsize}").tobytes()


def _numbers(data: bytes | pa.Buffer, size: int) -> np.ndarray:
    """So many packed numbers."""
    return np.frombuffer(data, f"<u{max(1, len(data) // max(1, size))}")


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of consecutive batches until their texts have so many bytes."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = 0
        for k, length in enumerate(lengths.tolist()):
            size += length
            if size >= most:
                yield pa.Table.from_batches([*held, batch.slice(start, k + 1 - start)])
                held, size, start = [], 0, k + 1
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def ordered(keys: np.ndarray) -> np.ndarray:
    """The positions of non-negative keys in their order, equal keys by position."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()) < 1 << (63 - bits):
        # key and position in one number: plain sorting is several times faster
        return np.sort((keys << bits) | np.arange(len(keys))) & ((1 << bits) - 1)
    return np.argsort(keys, kind="stable")


def transform(sequence: np.ndarray, longest: int) -> np.ndarray:
    """The Burrows-Wheeler transform over rotations sorted by their first ``longest`` symbols."""
    rank, known, order = sequence.astype(np.int64), 1, ordered(sequence.astype(np.int64))
    while known < longest:
        more = min(known, longest - known)
        # two sorted prefixes that overlap or meet make the longer one
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -more)
        order, known = ordered(key), known + more
        rank = np.empty_like(order)
        rank[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0) - 1
    return np.roll(sequence, 1)[order]


def _shard_row(rows: pa.Table, longest: int) -> pa.RecordBatch:
    words = words_of(rows.column("text").combine_chunks(), PIECE_BYTES, END)
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy()[words.text_of]
    width = max(1, len(words.dictionary))
    keys, at = np.unique(lang * width + words.ids, return_inverse=True)
    marks = pc.equal(words.dictionary, pa.scalar(END, pa.large_binary())).to_numpy(zero_copy_only=False)
    real = ~marks[keys % width] if len(keys) else np.zeros(0, dtype=bool)
    number = np.where(real, np.cumsum(real), 0)
    # a mark behind every text
    sequence = np.insert(number[at], words.bounds[1:], 0).astype(np.int32)
    counts = np.bincount(sequence, minlength=int(real.sum()) + 1)[1:]
    columns = {
        "lang_of": _packed(keys[real] // width),
        "words": b"".join(w + b" " for w in words.dictionary.take(pa.array(keys[real] % width)).to_pylist()),
        "counts": _packed(counts),
        "size": len(sequence),
        "forward": _packed(transform(sequence, longest)),
        "backward": _packed(transform(sequence[::-1], longest)),
    }
    values = [pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in columns.values()]
    known = langs.dictionary.cast(pa.binary())
    return pa.RecordBatch.from_arrays(
        [rows.column("row").chunk(0)[:1], lists(known, np.array([len(known)])), *values],
        names=["shard", "langs", *columns],
    )


def _sharded(longest: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches, shard_bytes):
            yield _shard_row(rows, longest)
        give_back_memory()

    return run


def _vocabulary(row: dict) -> tuple[pa.Array, pa.Array]:
    """The words of a shard with their lang (lang, tab, word) and without."""
    words = pa.array(row["words"].split(b" ")[:-1], pa.binary())
    lang = pa.array(row["langs"], pa.binary()).take(pa.array(_numbers(row["lang_of"], len(words))))
    return pc.binary_join_element_wise(lang, words, pa.scalar(b"\t", pa.binary())), words


def places(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where codes stand in an ordered list, -1 for those it lacks."""
    if not len(codes):
        return np.full(len(wanted), -1)
    at = np.searchsorted(codes, wanted)
    return np.where(codes[np.minimum(at, len(codes) - 1)] == wanted, at, -1)


def code_width(n_words: int, n_segments: int) -> int:
    """At least the number of words, and 1 modulo the segments: a code's segment, its remainder, then depends
    on the part and on the added word."""
    return n_words + (1 - n_words) % n_segments


@dataclass
class Likely:
    """What may be frequent: the frequent words, and by length from 2 the codes of the frequent phrases."""

    words: pa.Array
    n_segments: int
    codes: list[np.ndarray]

    def holds(self, index: ShardIndex, ids: np.ndarray) -> np.ndarray:
        return places(self.codes[ids.shape[1] - 2], phrase_codes(index, ids, self.n_segments)) >= 0

    def numbers_of(self, codes: np.ndarray, length: int) -> np.ndarray:
        """The numbers of the words of phrases."""
        if length == 1:
            return codes[:, None]
        part, added = np.divmod(codes, code_width(len(self.words), self.n_segments))
        numbers = self.numbers_of(part if length == 2 else self.codes[length - 3][part], length - 1)
        return np.hstack([numbers, added[:, None]] if length % 2 == 0 else [added[:, None], numbers])

    def spelled(self, codes: np.ndarray, length: int) -> pa.Array:
        """Phrases as lang, tab, words with single spaces between."""
        first, *more = (self.words.take(pa.array(n)) for n in self.numbers_of(codes, length).T)
        bare = [pa.array([w.rpartition(b"\t")[2] for w in words.to_pylist()], pa.binary()) for words in more]
        return pc.binary_join_element_wise(first, *bare, pa.scalar(b" ", pa.binary()))


class Side:
    """One transform: the words before each sorted rotation, and where a step to them leads."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols.astype(np.int64)

    @functools.cached_property
    def step(self) -> np.ndarray:
        order = ordered(self.symbols)
        step = np.empty_like(order)
        step[order] = np.arange(len(order))
        return step


class ShardIndex:
    """The FM-index of a shard, extended on both sides."""

    likely: Likely | None = None

    def __init__(self, row: dict):
        # word 0 is the mark between pieces
        mark = pa.array([b""], pa.binary())
        self.names, self.words = (pa.concat_arrays([mark, a]) for a in _vocabulary(row))
        counts = _numbers(row["counts"], len(self.words) - 1).astype(np.int64)
        forward, backward = (_numbers(row[side], row["size"]) for side in ("forward", "backward"))
        self.counts = np.concatenate([[len(forward) - counts.sum()], counts])
        self.forward, self.backward = Side(forward), Side(backward)

    def learn(self, likely: Likely) -> None:
        """Look up the words of the shard among the frequent ones; -1 for the others."""
        learn_all([self], likely)

    def single(self) -> tuple[np.ndarray, ...]:
        """The intervals of all words: (word ids, forward start, backward start, size)."""
        start = np.cumsum(self.counts) - self.counts
        ids = np.arange(1, len(self.counts))
        return ids[:, None], start[ids], start[ids], self.counts[ids]

    def extended(self, phrases: tuple[np.ndarray, ...], right: bool) -> tuple[np.ndarray, ...]:
        """All phrases longer by one word on one side, with their intervals."""
        ids, forward, backward, size = phrases
        side, near, far = (
            (self.backward, backward, forward) if right else (self.forward, forward, backward)
        )
        owner = np.repeat(np.arange(len(size)), size)
        ends = np.cumsum(size)
        at = np.arange(len(owner)) + np.repeat(near - (ends - size), size)
        key = owner * len(self.counts) + side.symbols[at]
        order = ordered(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        count = np.diff(np.append(first, len(key)))
        owner, symbol = np.divmod(key[first], len(self.counts))
        near_start = side.step[at[order[first]]]
        # the words smaller than this one come first in the other interval
        far_start = far[owner] + first - (ends - size)[owner]
        real = symbol > 0
        added = symbol[real, None]
        ids = np.hstack([ids[owner[real]], added] if right else [added, ids[owner[real]]])
        starts = near_start[real], far_start[real]
        return ids, *(starts[::-1] if right else starts), count[real]

    def spelled(self, ids: np.ndarray) -> pa.Array:
        """Phrases as lang, tab, words with single spaces between."""
        columns = [self.names.take(pa.array(ids[:, 0]))]
        columns += [self.words.take(pa.array(ids[:, k])) for k in range(1, ids.shape[1])]
        if len(columns) == 1:
            return columns[0]
        return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))


def learn_all(indexes: list[ShardIndex], likely: Likely) -> None:
    """``learn`` for several shards: the table of the frequent words is made once for all of them."""
    at = pc.fill_null(pc.index_in(pa.concat_arrays([x.names for x in indexes]), value_set=likely.words), -1)
    numbers = at.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum([len(x.names) for x in indexes])
    for index, own in zip(indexes, np.split(numbers, ends[:-1]), strict=True):
        index.likely, index.numbers = likely, own


def _kept(phrases: tuple[np.ndarray, ...], keep: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(part[keep] for part in phrases)


def _known(spelled: pa.Array, frequent: pa.Array) -> np.ndarray:
    return pc.is_valid(pc.index_in(spelled, value_set=frequent)).to_numpy(zero_copy_only=False)


def longer_phrases(
    index: ShardIndex, frequent: list[pa.Array], words: int = 1
) -> list[tuple[np.ndarray, ...]]:
    """Phrases longer than the longest ``frequent`` ones by one word, whose parts are both frequent, then
    those longer by up to ``words``."""
    phrases = index.single()
    for k, known in enumerate(frequent):
        phrases = _kept(phrases, _known(index.spelled(phrases[0]), known))
        phrases, other = _step(index, phrases, k)
        phrases = _kept(phrases, _known(index.spelled(other), known))
    found = [phrases]
    for k in range(len(frequent), len(frequent) + words - 1):
        found.append(_step(index, found[-1], k)[0])
    return found


def _step(index: ShardIndex, phrases: tuple[np.ndarray, ...], k: int) -> tuple[tuple, np.ndarray]:
    """Phrases longer by a word, on the right and on the left in turn, and their parts without the word
    on the other side."""
    right = k % 2 == 0
    phrases = index.extended(phrases, right)
    return phrases, phrases[0][:, 1:] if right else phrases[0][:, :-1]


def likely_phrases(index: ShardIndex, likely: Likely, words: int) -> list[tuple[np.ndarray, ...]]:
    """By length from 2, for up to ``words`` lengths: phrases that may be frequent, as may their parts."""
    if index.likely is not likely:
        index.learn(likely)
    known = index.numbers >= 0
    single = index.single()
    phrases, found = _kept(single, known[single[0][:, 0]]), []
    for k in range(words):
        phrases, other = _step(index, phrases, k)
        if k == 0:
            phrases = _kept(phrases, known[other[:, 0]])
        elif k <= len(likely.codes):
            phrases = _kept(phrases, likely.holds(index, other))
        if k < len(likely.codes):
            phrases = _kept(phrases, likely.holds(index, phrases[0]))
        found.append(phrases)
    return found


def phrase_codes(index: ShardIndex, ids: np.ndarray, n_segments: int) -> np.ndarray:
    """A number of each phrase, the same in all shards and no other phrase's of its length; -1 where a word or
    the part without the word that was added last is not frequent."""
    length = ids.shape[1]
    if length == 1:
        return index.numbers[ids[:, 0]]
    right = length % 2 == 0
    part = phrase_codes(index, ids[:, :-1] if right else ids[:, 1:], n_segments)
    if length > 2:
        part = places(index.likely.codes[length - 3], part)
    added = index.numbers[ids[:, -1 if right else 0]]
    codes = part * code_width(len(index.likely.words), n_segments) + added
    return np.where((part < 0) | (added < 0), -1, codes)


BLOCKS = "segment long, size long, codes binary, counts binary"


def _unpacked(block: pa.Table, name: str) -> np.ndarray:
    parts = zip(block.column(name), block.column("size").to_pylist(), strict=True)
    return np.concatenate([_numbers(b.as_buffer(), n) for b, n in parts])


def _blocks(held: list[tuple[np.ndarray, np.ndarray]], n_segments: int) -> pa.RecordBatch:
    """The codes and counts of several shards, added up, as one row a segment."""
    codes, counts = (np.concatenate(part) for part in zip(*held, strict=True))
    quotients = int(codes.max()) // n_segments + 1
    keys, counts = counted(codes % n_segments * quotients + codes // n_segments, counts)
    segment, codes = np.divmod(keys, quotients)
    first = np.flatnonzero(np.diff(segment, prepend=-1))
    ends = np.append(first[1:], len(codes))
    blocks = [
        [_packed(v[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)] for v in (codes, counts)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(segment[first]), pa.array(ends - first), *(pa.array(b, pa.binary()) for b in blocks)],
        names=["segment", "size", "codes", "counts"],
    )


def _code_blocks(sent):
    """The longest likely phrases of the shards of a task, as codes with their counts added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = sent.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            indexes = [index for _, index in _indexes([batch])]
            learn_all(indexes, likely)
            for index in indexes:
                ids, _, _, count = likely_phrases(index, likely, len(likely.codes) + 1)[-1]
                if len(ids):
                    held.append((phrase_codes(index, ids, likely.n_segments), count))
                if sum(len(codes) for codes, _ in held) >= MERGED_CODES:
                    yield from by_bytes([_blocks(held, likely.n_segments)], "codes", BATCH_BYTES // 4)
                    held = []
        if held:
            yield from by_bytes([_blocks(held, likely.n_segments)], "codes", BATCH_BYTES // 4)
        give_back_memory()

    return run


def _frequent_in(block: pa.Table, least: int, n_segments: int) -> pa.Table:
    """The codes of a segment whose counts sum to ``least`` or more, with their counts."""
    segment = block.column("segment")[0].as_py()
    codes, counts = (_unpacked(block, name).astype(np.int64) for name in ("codes", "counts"))
    codes, counts = counted(codes, counts)
    codes, counts = (v[counts >= least] for v in (codes * n_segments + segment, counts))
    return pa.table({"codes": [codes.astype("<i8").tobytes()], "counts": [counts.astype("<i8").tobytes()]})


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, ShardIndex]]:
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row["shard"], ShardIndex(row)


REPORT = "shard long, phrase binary, n long"


def _report(shard: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(phrases), shard)), phrases, pa.array(counts, pa.int64())],
        names=["shard", "phrase", "n"],
    )


def _own_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            names = _vocabulary(row)[0]
            yield _report(row["shard"], names, _numbers(row["counts"], len(names)))


def _frequent_codes(shards: DataFrame, sent, n_segments: int, least: int) -> DataFrame:
    """The codes of all phrases one word longer that have ``least`` occurrences, with their counts."""
    blocks = shards.mapInArrow(_code_blocks(sent), BLOCKS).groupBy("segment")
    return stored(
        blocks.applyInArrow(
            lambda block: _frequent_in(block, least, n_segments), "codes binary, counts binary"
        ),
        "phrase-codes",
    )


def _spelled(found: DataFrame, sent, length: int) -> DataFrame:
    """Phrases of a length from their codes, once each, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, counts = (np.frombuffer(row[name], "<i8") for name in ("codes", "counts"))
                yield pa.RecordBatch.from_arrays(
                    [sent.value.spelled(codes, length), pa.array(counts)], names=["phrase", "n"]
                )

    return found.mapInArrow(run, "phrase binary, n long")


def _reports(shard: int, index: ShardIndex, found: list) -> list[pa.RecordBatch]:
    return [_report(shard, index.spelled(ids), count) for ids, _, _, count in found]


def _reported_by_own(
    shards: DataFrame, reports: list[DataFrame], frequent: list[DataFrame], words: int
) -> DataFrame:
    """Longer phrases, each shard being sent the frequent ones among those it has reported."""
    known = [
        r.join(f.select("phrase"), "phrase", "left_semi").select(
            F.col("shard").alias("own"), F.lit(k).alias("k"), "phrase"
        )
        for k, (r, f) in enumerate(zip(reports, frequent, strict=True))
    ]
    together = known[0]
    for more in known[1:]:
        together = together.unionByName(more)
    lengths = range(len(frequent))

    def run(held: pa.Table, own: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        parts = [
            own.filter(pc.equal(own.column("k"), k)).column("phrase").combine_chunks() for k in lengths
        ]
        rows = []
        for shard, index in _indexes(held.to_batches()):
            rows += _reports(shard, index, longer_phrases(index, parts, words))
        return pa.Table.from_batches(rows, schema=_report(0, parts[0][:0], np.zeros(0)).schema)

    return shards.groupBy("shard").cogroup(together.groupBy("own")).applyInArrow(run, REPORT)


def _summed(reports: DataFrame) -> DataFrame:
    return reports.groupBy("phrase").agg(F.sum("n").alias("n"))


def phrase_counts(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    broadcast_bytes: int = BROADCAST_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and by length from 1 the phrases (lang, tab, words) with ``least`` or more."""
    rows = docs.select(
        row_id().alias("row"),
        F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"),
        text_of().cast("binary").alias("text"),
    )
    bounded_batches(docs.sparkSession)
    bounded_bytes(docs.sparkSession, BATCH_BYTES)
    shards = stored(rows.mapInArrow(_sharded(longest, shard_bytes), SHARD), "phrase-shards", **ROW_GROUPS)
    own_words = shards.select("shard", "langs", "lang_of", "words", "counts").mapInArrow(_own_words, REPORT)
    words = stored(_summed(own_words), "phrase-words")
    totals = words.groupBy(_lang(F.col("phrase")).alias("lang")).agg(F.sum("n").alias("n"))
    frequent = [stored(words.filter(F.col("n") >= least), "phrases-1")]
    n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    longer = _by_codes(shards, frequent[0], least, longest, n_words, broadcast_bytes)
    if longer is not None:
        return stored(totals, "phrase-totals"), frequent + longer
    n_words_in = F.size(F.split(_phrase(F.col("phrase")), " "))
    # what is left after three words is little: all longer phrases come from one pass
    reports = [own_words]
    for length, more in [(2, 1), (3, 1), (4, longest - 3)]:
        if length > longest:
            break
        found = _reported_by_own(shards, reports, frequent, more)
        reports.append(stored(found, f"phrase-reports-{length}"))
        sums = stored(_frequent(reports[-1], least), f"phrases-{length}")
        frequent += [sums.filter(n_words_in == length + k) for k in range(more)]
    return stored(totals, "phrase-totals"), frequent


def _by_codes(
    shards: DataFrame, words: DataFrame, least: int, longest: int, n_words: int, most_bytes: int
) -> list[DataFrame] | None:
    """By length from 2 the frequent phrases; None if words or codes are too many to be broadcast."""
    if _bytes(words) > most_bytes:
        return None
    known = words.select("phrase").toArrow().column("phrase").combine_chunks()
    likely = Likely(known, max(1, -(-n_words // SEGMENT_WORDS)), [])
    levels = []
    for length in range(2, longest + 1):
        sent = shards.sparkSession.sparkContext.broadcast(likely)
        found = _frequent_codes(shards, sent, likely.n_segments, least)
        levels.append(stored(_spelled(found, sent, length), f"phrases-{length}"))
        if length < longest:
            if found.agg(F.coalesce(F.sum(F.length("codes")), F.lit(0))).first()[0] > most_bytes:
                return None
            rows = found.select("codes").toLocalIterator()
            codes = np.frombuffer(b"".join(bytes(row["codes"]) for row in rows), "<i8")
            likely.codes.append(np.sort(codes))
    return levels


def _frequent(reports: DataFrame, least: int) -> DataFrame:
    return _summed(reports).filter(F.col("n") >= least)


def _bytes(phrases: DataFrame) -> int:
    return phrases.agg(F.coalesce(F.sum(F.length("phrase") + 8), F.lit(0))).first()[0]


def _phrase(key: Column) -> Column:
    return F.substring_index(key.cast("string"), "\t", -1)


def _lang(key: Column) -> Column:
    """What stands before the last tab; words hold none."""
    size = F.length(key.cast("string")) - F.length(_phrase(key)) - 1
    return F.substring(key.cast("string"), F.lit(1), size)


def _scored(longer: DataFrame, parts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase at its lowest-scoring cut: lang, phrase, a, l, r, n, score."""
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.concat_ws("\t", "lang", F.array_join(F.slice(words, F.lit(1), k), " ")).alias("first"),
            F.concat_ws("\t", "lang", F.array_join(F.slice(words, k + 1, F.size(words)), " ")).alias("rest"),
        ),
    )
    cut = longer.select("key", "lang", "phrase", "a", F.explode(cuts).alias("cut"))
    cut = cut.select("key", "lang", "phrase", "a", "cut.k", "cut.first", "cut.rest")
    first = parts.select(F.col("key").alias("first"), F.col("a").alias("l"))
    rest = parts.select(F.col("key").alias("rest"), F.col("a").alias("r"))
    whole = cut.join(totals, "lang").join(first, "first").join(rest, "rest")
    wide = {name: f"cast({name} as decimal(19,0))" for name in "anlr"}
    score = F.expr(
        f"(cast(1000 as decimal(4,0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = whole.groupBy("key", "lang", "phrase", "a", "n").agg(lowest.alias("cut"))
    return scored.select("key", "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **ways: int) -> DataFrame:
    """The first ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    totals, frequent = phrase_counts(docs, least, **ways)
    if totals.count() <= MOST_LANGS:
        totals = F.broadcast(totals)
    parts = frequent[0].withColumn("words", F.lit(1))
    for k, more in enumerate(frequent[1:]):
        parts = parts.unionByName(more.withColumn("words", F.lit(k + 2)))
    parts = parts.select(
        F.col("phrase").cast("string").alias("key"),
        _lang(F.col("phrase")).alias("lang"),
        _phrase(F.col("phrase")).alias("phrase"),
        F.col("n").alias("a"),
        "words",
    )
    longer = parts.filter("words > 1")
    inside = F.split("phrase", " ")
    halves = F.array(
        F.slice(inside, F.lit(1), F.size(inside) - 1), F.slice(inside, F.lit(2), F.size(inside) - 1)
    )
    covering = (
        parts.filter("words > 2")
        .select("lang", "a", F.explode(F.array_distinct(halves)).alias("part"))
        .groupBy(F.concat_ws("\t", "lang", F.array_join("part", " ")).alias("key"))
        .agg(F.max("a").alias("most"))
    )
    left = longer.join(covering, "key", "left").filter("most is null or most < a")
    scored = _scored(left, parts, totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
