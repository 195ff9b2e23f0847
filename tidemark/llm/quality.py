"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is cut into equal pieces of about ``PIECE_BYTES``, and each piece is compressed with the
dictionary of good text (g bytes) and with that of bad text (b bytes). The normalised difference
(b - g) / max(b, g) says which kind of text the piece shares phrases with; per byte, and beside the
compressed share min(b, g) / bytes, it also tells repetition, which either dictionary compresses. The
mean over the pieces and the least piece of these three enter a logistic calibration, so a bad passage
in a good text shows. Nothing but the text is an input of the score.

Fitting uses a bounded sample of labelled rows, in the order of a hash of the document number:
``DICTIONARY_ROWS`` rows of each class give one piece each, of which the first ``DICTIONARY_BYTES`` of a
class are used (about 490 pieces of full length), and up to ``CALIBRATION_ROWS`` others in
their natural mix give the calibration. Scoring reads every text whole, piece by piece.

Defined cases: a null text counts as empty, and an empty text is one empty piece with a score like any
other; without labelled rows of both classes the score is the share of good rows, or 0.5 without any;
labels that are null or not 0 or 1 are ignored; repeated rows are scored alike; an empty table gives no
rows. Of documents that share sampled doc_ids, no more than the bounds are learned from, in the order of
a hash of doc_id and then of the text. Other columns are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, text_of

PIECE_BYTES = 1024
DICTIONARY_BYTES = 500_000
DICTIONARY_ROWS = {1: 2000, 0: 1000}
CALIBRATION_ROWS = 6000
LEVEL = 3
THRESHOLD = 0.7
N_FEATURES = 6


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration; a few hundred kilobytes."""

    good: bytes
    bad: bytes
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float

    def probability(self, features: np.ndarray) -> np.ndarray:
        scaled = (features - np.array(self.center)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(scaled @ np.array(self.weights) + self.bias, -40, 40)))


class Measure:
    """The six features of a text under a pair of dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = self._compressor(good), self._compressor(bad)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        # zstandard takes raw content from eight bytes on
        content = content.ljust(8)
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=shared,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )

    def __call__(self, text: bytes) -> np.ndarray:
        n_pieces = max(1, -(-len(text) // PIECE_BYTES))
        size = max(1, -(-len(text) // n_pieces))
        pieces = [text[k : k + size] for k in range(0, max(1, len(text)), size)]
        good = np.array([len(self.good.compress(p)) for p in pieces], dtype=float)
        bad = np.array([len(self.bad.compress(p)) for p in pieces], dtype=float)
        length = np.array([len(p) + 1 for p in pieces], dtype=float)
        per_piece = ((bad - good) / np.maximum(good, bad), (bad - good) / length)
        share = np.minimum(good, bad) / length
        return np.array([f(x) for x in (*per_piece, share) for f in (np.mean, np.min)])


def _labelled(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts of chosen labelled rows; ``rows`` is bounded, so it may be broadcast."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(
        F.broadcast(rows), "doc_id"
    )


def sample_rows(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounded samples (doc_id, quality) for the dictionaries and for the calibration."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    for_dictionary = F.pmod(F.xxhash64("doc_id", F.lit("role")), F.lit(2)) == 0
    classes = [
        known.filter(for_dictionary & (F.col("quality") == kind)).orderBy(order).limit(most)
        for kind, most in DICTIONARY_ROWS.items()
    ]
    calibration = known.filter(~for_dictionary).orderBy(order).limit(CALIBRATION_ROWS)
    return classes[0].unionByName(classes[1]), calibration


def _measured(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(good, bad)
        for batch in batches:
            rows = [measure(t.as_buffer().to_pybytes()).tolist() for t in batch.column("text")]
            keys = ["quality", "order", "next"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keys), pa.array(rows, pa.list_(pa.float64()))],
                names=[*keys, "features"],
            )

    return run


def _logistic(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps with a small ridge; the number of features is fixed."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-2)
    ridge[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (labels - p) - ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the labelled rows that are not held out."""
    for_dictionary, for_calibration = sample_rows(labels)
    n_chars = F.length("text")
    start = F.pmod(F.xxhash64("text"), F.greatest(n_chars - PIECE_BYTES, F.lit(0)) + 1) + 1
    found = _labelled(docs, for_dictionary).select(
        "quality",
        F.xxhash64("doc_id").alias("order"),
        F.substring(F.col("text"), start.cast("int"), F.lit(PIECE_BYTES)).alias("piece"),
    )
    # many documents may carry a sampled doc_id: the bounds hold for them too
    pieces = [
        row
        for kind, most in DICTIONARY_ROWS.items()
        for row in found.filter(F.col("quality") == kind).orderBy("order", "piece").limit(most).collect()
    ]
    content = {
        kind: "\n".join(row["piece"] for row in pieces if row["quality"] == kind).encode()
        for kind in (0, 1)
    }
    good, bad = (content[kind][:DICTIONARY_BYTES] for kind in (1, 0))
    chosen = _labelled(docs, for_calibration).select(
        "quality",
        F.xxhash64("doc_id").alias("order"),
        F.xxhash64("text").alias("next"),
        F.col("text").cast("binary").alias("text"),
    )
    measured = chosen.mapInArrow(
        _measured(good, bad), "quality int, order long, next long, features array<double>"
    )
    ordered = measured.orderBy("order", "next", "quality").limit(CALIBRATION_ROWS)
    rows = ordered.select("quality", "features").toPandas()
    y = rows["quality"].to_numpy(dtype=float)
    constant = QualityModel(good, bad, (0.0,) * 6, (1.0,) * 6, (0.0,) * 6, 0.0)
    if not len(y) or y.min() == y.max():
        share = min(max(y.mean() if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return QualityModel(
            good, bad, constant.center, constant.scale, constant.weights,
            float(np.log(share / (1 - share))),
        )
    x = np.array(rows["features"].tolist())
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights, bias = _logistic((x - center) / scale, y)
    return QualityModel(good, bad, *(tuple(v.tolist()) for v in (center, scale, weights)), bias)


def _scored(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(model.good, model.bad)
        for batch in batches:
            texts = batch.column("text")
            features = np.array([measure(t.as_buffer().to_pybytes()) for t in texts])
            scores = model.probability(features.reshape(len(texts), N_FEATURES))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores)], names=[*names, "score"]
            )

    return run


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text")
    )
    return rows.mapInArrow(_scored(model), "doc_id long, score double").select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches the threshold, all columns unchanged, without a shuffle."""
    bounded_batches(docs.sparkSession)
    # plain names on the way, so that any name of a column comes through
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(model.good, model.bad)
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(column)]
            features = np.array([measure(t) for t in texts])
            scores = model.probability(features.reshape(len(texts), N_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"]
            )

    scored = plain.mapInArrow(run, schema)
    return scored.filter(F.col("score") >= threshold).drop("score").toDF(*docs.columns)
