"""Ranked lexical search over a length-stratified index.

The length normaliser m of a document follows from its number of terms n: 75 + (25 n N) div L, where N
documents hold L terms in all. Documents of equal m are a stratum. The index is a table with a row for each
slice of documents (about ``SLICE_BYTES`` of text): its strata, its distinct terms, and for each term, in each
stratum, the postings grouped by term frequency, highest first. Rows are large, so they are stored in row groups
of a few rows, and Arrow batches are bounded by bytes: a task holds few slices at a time, however many it makes.

In a stratum m is one number, so the impact of a term depends on tf alone: it is computed once for each
(term, stratum, tf) and holds for all postings of that group. The first group of a term is its greatest impact
in the stratum; the sum of those over a query's terms bounds every score there. Strata are visited by
falling bound, in steps that double, until the bound falls below the k-th best score so far; equal bounds are
visited too, as a smaller doc_id wins a tie. Each slice gives its k best documents a query; a task merges those of its
slices, and the k best of all are kept.

Queries are taken in blocks of about ``BLOCK_BYTES`` of text, each broadcast to one pass over the index, so
neither queries nor answers have to fit one machine.

All scores are integers: the weight of a term is floor(1000 ln((2N + 2) / (2 df + 1))), its impact
weight * ((10^9 tf) div (1000 tf + 12 m)), and repeats of a term in the query count each.

Defined cases: a null or empty text has no terms, counts in no figure and is never found; a query without
terms, or whose terms no document holds, has no rows; equal scores rank by doc_id, null doc_ids last;
repeated documents are found each, repeated queries are answered each; an empty table gives no rows; other
columns are ignored. One text is in memory whole, with about 60 bytes a term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import give_back_memory
from tidemark.llm.common import bounded_batches, bounded_bytes, new_folder, row_id, stored, text_of
from tidemark.llm.words import LOWER, Words, by_bytes, counted, lists, words_of

TOP = 20
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
# Answers that a task holds to merge them with those of its next slice.
HELD_ROWS = 1 << 20
# Parquet looks at the size of what it holds after 100 rows only, unless told otherwise.
ROW_GROUPS = {
    "parquet.block.row.count.limit": "4",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}
LAST_ID = (1 << 63) - 1
# Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
TERM_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
).translate(LOWER)

INDEX = (
    "doc_ids array<long>, strata array<long>, terms array<binary>, df array<int>,"
    " term_groups array<int>, group_stratum array<int>, group_tf array<int>,"
    " group_start array<int>, postings array<int>"
)


@dataclass
class SearchIndex:
    """The stored index and the figures that its scores use."""

    slices: DataFrame
    n_docs: int
    n_terms: int


def _texts(docs: DataFrame, key: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    bounded_bytes(docs.sparkSession, BATCH_BYTES)
    return docs.select(F.col(key).cast("long").alias("id"), text_of().cast("binary").alias("text"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        sizes = [len(t.as_buffer().to_pybytes().translate(TERM_BYTES).split()) for t in texts]
        sums = [[sum(n > 0 for n in sizes)], [sum(sizes)]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in sums], names=["n", "l"])


def normaliser(n: int, n_docs: int, n_terms: int) -> int:
    """m of a document of n terms."""
    return 100 - 25 + (25 * n * n_docs) // n_terms


def _indexed(n_docs: int, n_terms: int):
    """One row a slice: documents by stratum, terms, and groups (term, stratum, falling tf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, most=SLICE_BYTES):
            words = words_of(batch.column("text"), TERM_BYTES)
            if len(words.ids):
                yield _index_row(batch.column("id"), words, n_docs, n_terms)
        give_back_memory()

    return run


def _index_row(ids: pa.Array, words: Words, n_docs: int, n_terms: int) -> pa.RecordBatch:
    sizes, of_size = np.unique(words.lengths, return_inverse=True)
    m = np.array([normaliser(int(n), n_docs, n_terms) for n in sizes], dtype=np.int64)[of_size]
    strata, stratum = np.unique(m, return_inverse=True)
    width = len(words.dictionary)
    pairs, tf = counted(words.text_of * width + words.ids)
    doc, term = pairs // width, pairs % width
    order = np.lexsort((doc, -tf, stratum[doc], term))
    doc, term, tf = doc[order], term[order], tf[order]
    level = stratum[doc]
    new = (np.diff(term) != 0) | (np.diff(level) != 0) | (np.diff(tf) != 0)
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    counts = np.bincount(term, minlength=width)
    columns = {
        "doc_ids": ids,
        "strata": pa.array(strata, pa.int64()),
        "terms": words.dictionary.cast(pa.binary()),
        "df": pa.array(counts, pa.int32()),
        "term_groups": pa.array(np.searchsorted(term[first], np.arange(width + 1)), pa.int32()),
        "group_stratum": pa.array(level[first], pa.int32()),
        "group_tf": pa.array(tf[first], pa.int32()),
        "group_start": pa.array(np.append(first, len(doc)), pa.int32()),
        "postings": pa.array(doc, pa.int32()),
    }
    row = [lists(values, np.array([len(values)])) for values in columns.values()]
    return pa.RecordBatch.from_arrays(row, names=list(columns))


def build_index(docs: DataFrame) -> SearchIndex:
    """Index all documents: one pass for the figures, one for the slices."""
    texts = _texts(docs, "doc_id")
    sums = texts.select("text").mapInArrow(_sizes, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    n_docs, n_terms = (int(x or 0) for x in sums)
    slices = texts.mapInArrow(_indexed(n_docs, n_terms), INDEX)
    return SearchIndex(stored(slices, "search-index", **ROW_GROUPS), n_docs, n_terms)


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each query with their repeats; queries are dealt to blocks by size."""
    for batch in by_bytes(batches, most=BLOCK_BYTES):
        words = words_of(batch.column("text"), TERM_BYTES)
        width = max(1, len(words.dictionary))
        pairs, times = counted(words.text_of * width + words.ids)
        query, terms = pairs // width, words.dictionary.take(pa.array(pairs % width))
        rows = pa.array(query)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([batch.column("row")[0].as_py()] * len(rows), pa.int64()),
                batch.column("row").take(rows),
                batch.column("id").take(rows),
                terms.cast(pa.binary()),
                pa.array(times, pa.int64()),
            ],
            names=["block", "row", "id", "term", "times"],
        )


def weight(df: int, n_docs: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _frequencies(terms: pa.Array):
    """Document frequencies of some terms, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.index_in(batch.column("terms").flatten(), value_set=terms)
            here = pc.is_valid(found)
            yield pa.RecordBatch.from_arrays(
                [found.filter(here), batch.column("df").flatten().filter(here)], names=["term", "df"]
            )

    return run


@dataclass
class Queries:
    """A block of queries: distinct terms with weights, and for each query its terms and repeats."""

    terms: pa.Array
    weights: np.ndarray
    rows: list[int]
    members: list[tuple[np.ndarray, np.ndarray]]


class Slice:
    """One row of the index, ready for a block of queries."""

    def __init__(self, batch: pa.RecordBatch, k: int, queries: Queries):
        part = {name: batch.column(name).slice(k, 1).flatten() for name in batch.schema.names}
        self.ids = pc.fill_null(part["doc_ids"], LAST_ID).to_numpy(zero_copy_only=False)
        self.unnamed = part["doc_ids"].is_null().to_numpy(zero_copy_only=False)
        self.m = part["strata"].to_numpy()
        groups = part["term_groups"].to_numpy()
        self.stratum, self.tf = part["group_stratum"].to_numpy(), part["group_tf"].to_numpy().astype(np.int64)
        self.start, self.postings = part["group_start"].to_numpy(), part["postings"].to_numpy()
        at = pc.index_in(queries.terms, value_set=part["terms"])
        self.groups: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for term, own in enumerate(at.to_pylist()):
            if own is not None:
                of_term = np.arange(groups[own], groups[own + 1])
                stratum, tf = self.stratum[of_term], self.tf[of_term]
                impact = queries.weights[term] * ((10**9 * tf) // (1000 * tf + 12 * self.m[stratum]))
                highest = np.concatenate([[True], stratum[1:] != stratum[:-1]])
                self.groups[term] = of_term, impact, highest

    def best(self, terms: np.ndarray, times: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` documents (positions, scores) with a score above 0."""
        mine = [(self.groups[t], n) for t, n in zip(terms.tolist(), times.tolist(), strict=True) if t in self.groups]
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if not mine:
            return docs, scores
        group = np.concatenate([g for (g, _, _), _ in mine])
        impact = np.concatenate([i * n for (_, i, _), n in mine])
        highest = np.concatenate([h for (_, _, h), _ in mine])
        bound = np.zeros(len(self.m), dtype=np.int64)
        np.add.at(bound, self.stratum[group[highest]], impact[highest])
        visits = np.argsort(-bound, kind="stable")
        place = np.empty(len(visits), dtype=np.int64)
        place[visits] = np.arange(len(visits))
        rank = place[self.stratum[group]]
        order = np.argsort(rank, kind="stable")
        group, impact, rank = group[order], impact[order], rank[order]
        a, step = 0, 1
        while a < len(visits) and bound[visits[a]] > 0:
            if len(scores) == top and bound[visits[a]] < scores[-1]:
                break
            b = a + step
            i, j = np.searchsorted(rank, [a, b])
            more, sums = self._scores(group[i:j], impact[i:j])
            docs, scores = self._top(np.append(docs, more), np.append(scores, sums), top)
            a, step = b, 2 * step
        return docs, scores

    def _scores(self, group: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole scores of the documents in some groups."""
        start, sizes = self.start[group], self.start[group + 1] - self.start[group]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)
        sums = np.zeros(len(self.ids), dtype=np.int64)
        np.add.at(sums, self.postings[at], np.repeat(impact, sizes))
        found = np.flatnonzero(sums > 0)
        return found, sums[found]

    def _top(self, docs: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        if len(scores) > top:
            enough = scores >= np.partition(scores, len(scores) - top)[len(scores) - top]
            docs, scores = docs[enough], scores[enough]
        order = np.lexsort((self.ids[docs], self.unnamed[docs], -scores))[:top]
        return docs[order], scores[order]


def _searched(sent, top: int):
    """The best documents of each query in the slices of a task, merged slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        for batch in batches:
            for k in range(len(batch)):
                part = Slice(batch, k, queries)
                found = [part.best(*members, top) for members in queries.members]
                rows = np.repeat(np.array(queries.rows, dtype=np.int64), [len(d) for d, _ in found])
                docs = np.concatenate([d for d, _ in found]) if found else np.zeros(0, dtype=np.int64)
                scores = np.concatenate([s for _, s in found]) if found else docs
                new = rows, part.ids[docs], part.unnamed[docs], scores
                held = _merged([np.concatenate(pair) for pair in zip(held, new, strict=True)], top)
                if len(held[0]) > HELD_ROWS:
                    yield _answers(*held)
                    held = [column[:0] for column in held]
        yield _answers(*held)
        give_back_memory()

    return run


def _merged(columns: list[np.ndarray], top: int) -> list[np.ndarray]:
    """The ``top`` best of each query."""
    rows, ids, unnamed, scores = columns
    order = np.lexsort((ids, unnamed, -scores, rows))
    rows = rows[order]
    order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < top]
    return [column[order] for column in columns]


def _answers(rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(rows), pa.array(ids, mask=unnamed), pa.array(scores)]
    return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "score"])


def _block(index: SearchIndex, rows: pa.Table) -> Queries:
    """A block's terms with their weights in this index."""
    coded = rows.column("term").combine_chunks().dictionary_encode()
    counts = index.slices.select("terms", "df").mapInArrow(
        _frequencies(coded.dictionary), "term int, df int"
    )
    found = {r["term"]: r["df"] for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weights = [weight(found.get(k, 0), index.n_docs) for k in range(len(coded.dictionary))]
    query, terms = rows.column("row").to_numpy(), coded.indices.to_numpy()
    times = rows.column("times").to_numpy()
    order = np.argsort(query, kind="stable")
    query, terms, times = query[order], terms[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(query) != 0]))
    ends = [*first[1:].tolist(), len(query)]
    members = [(terms[a:b], times[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
    return Queries(coded.dictionary, np.array(weights, dtype=np.int64), query[first].tolist(), members)


def search(index: SearchIndex, queries: DataFrame, key: str = "item_id", top: int = TOP) -> DataFrame:
    """(``key``, rank, doc_id, score): the ``top`` best documents of each query with a score above 0."""
    spark = queries.sparkSession
    numbered = _texts(queries, key).withColumn("row", row_id())
    terms = stored(
        numbered.mapInArrow(
            _blocks_of, "block long, row long, id long, term binary, times long"
        ),
        "search-queries",
    )
    found = new_folder(spark, "search-found")
    answers = "row long, doc_id long, score long"
    spark.createDataFrame([], answers).write.parquet(found)
    for block in terms.select("block").distinct().orderBy("block").toLocalIterator():
        rows = terms.filter(F.col("block") == block["block"]).select("row", "term", "times").toArrow()
        sent = spark.sparkContext.broadcast(_block(index, rows))
        best = index.slices.drop("df").mapInArrow(_searched(sent, top), answers)
        best.write.mode("append").parquet(found)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = spark.read.schema(answers).parquet(found)
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = terms.select("row", F.col("id").alias(key)).distinct()
    return ranked.join(names, "row").select(key, "rank", "doc_id", "score")
