"""Quality classifier: a factorisation machine (operator 3).

A text's features are its hashed words, its hashed word shapes (letters and
digits reduced to one sign each run, other signs kept), the text's structure
(lengths, shares of signs, repetition) and its own metadata (size, lines).
Labels, language, source and id are never inputs of a score.

score = sigmoid(w0 + w.x + sum over pairs of <v_i, v_j> x_i x_j), where the sum
over pairs is half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): linear
in the number of features.

The model is fitted on at most ``max_rows`` labelled rows outside the held-out
fold, chosen by the hash of their id; only their features reach the driver.
The same rows give the same model.

Edge cases: null and empty texts have the structure features of an empty text
and get a score like any other; a row with a null id is never learned from and
counts as held out; repeated rows each get a row; labels that are null, and
labels of ids that do not occur, are not used; differing labels of one id count
as the lower; without any usable label every score is 0.5; whole texts of any
length are read in pieces.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from tillstack.llm.common import byte_values, small_batches, word_chunks

WORD_BUCKETS, SHAPE_BUCKETS, FACTORS = 4096, 512, 8
MAX_ROWS, EPOCHS, FOLDS, THRESHOLD = 6000, 12, 5, 0.3
_STATS = 16
SIZE = WORD_BUCKETS + SHAPE_BUCKETS + _STATS

_SHAPE = bytes(ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c
               for c in range(256))
_RUNS = [(re.compile(sign + b"+"), sign) for sign in (b"a", b"A", b"0")]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one text's features."""
    words, shapes, n_words, signs = Counter(), Counter(), 0, Counter()
    for chunk in word_chunks(data):
        joined = b" ".join(chunk)
        shape = joined.translate(_SHAPE)
        signs["a"] += shape.count(b"a")
        signs["A"] += shape.count(b"A")
        signs["0"] += shape.count(b"0")
        signs["word"] += len(joined) - max(0, len(chunk) - 1)
        for run, sign in _RUNS:
            shape = run.sub(sign, shape)
        words.update(chunk)
        shapes.update(shape.split(b" ") if chunk else ())
        n_words += len(chunk)
    letters, total = max(1, signs["a"] + signs["A"]), max(1, signs["word"])
    lines = data.count(b"\n") + 1
    stats = np.array([
        1.0, np.log1p(len(data)) / 12, np.log1p(n_words) / 10, np.log1p(lines) / 6, total / max(1, n_words) / 10,
        signs["A"] / letters, signs["0"] / total, (total - letters - signs["0"]) / total, len(words) / max(1, n_words),
        max(words.values(), default=0) / max(1, n_words), np.log1p(n_words / lines) / 5, float(not n_words),
        data.count(b".") / max(1, n_words), data.count(b",") / max(1, n_words), len(shapes) / max(1, n_words),
        max(shapes.values(), default=0) / max(1, n_words)], np.float32).clip(0, 3)

    def hashed(counts: Counter, size: int) -> np.ndarray:
        out = np.zeros(size, np.float32)
        if counts:
            at = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % size
            np.add.at(out, at, np.fromiter(counts.values(), np.float32, len(counts)))
            out = np.sqrt(out)
            out /= np.sqrt((out * out).sum())
        return out

    dense = np.concatenate((hashed(words, WORD_BUCKETS), hashed(shapes, SHAPE_BUCKETS), stats))
    at = np.flatnonzero(dense)
    return at.astype(np.int32), dense[at]


@dataclass
class FactorisationMachine:
    """Weights; ``bias`` is w0, ``linear`` w, ``factors`` the rows v_i."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        sums = x @ self.factors
        pairs = 0.5 * (sums * sums - (x * x) @ (self.factors * self.factors)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(self.bias + x @ self.linear + pairs, -30, 30)))

    @staticmethod
    def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02,
            decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
        """Logistic loss, Adam steps over batches of 64 rows."""
        rng = np.random.default_rng(seed)
        share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
        params = [np.array([np.log(share / (1 - share))]), np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS))]
        if not len(labels) or labels.min() == labels.max():
            return FactorisationMachine(float(params[0][0]), params[1], np.zeros_like(params[2]))
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            turn = rng.permutation(len(labels))
            for at in range(0, len(turn), 64):
                some = turn[at:at + 64]
                x, y = dense([rows[i] for i in some]), labels[some]
                sums = x @ params[2]
                z = params[0][0] + x @ params[1] + 0.5 * (sums * sums - (x * x) @ (params[2] * params[2])).sum(axis=1)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(some)
                grads = [np.array([err.sum()]), x.T @ err + decay * params[1],
                         x.T @ (err[:, None] * sums) - ((x * x).T @ err)[:, None] * params[2] + decay * params[2]]
                step += 1
                for p, g, a, b in zip(params, grads, first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        return FactorisationMachine(float(params[0][0]), params[1], params[2])


def dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), SIZE))
    for r, (at, value) in enumerate(rows):
        out[r, at] = value
    return out


def held_out(id_col: str = "doc_id"):
    """The fold that is never learned from: CRC-32 of the id's text divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id_col: str = "doc_id",
          max_rows: int = MAX_ROWS) -> FactorisationMachine:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold."""
    small_batches(docs.sparkSession)
    chosen = (labels.filter(~held_out(id_col)).filter(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id"))
              .agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t) for t in byte_values(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.float32()))], ["id", "label", "at", "value"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    # at most max_rows ids: a broadcast of known size, and the documents need no shuffle
    found = rows.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(run, StructType(
        [StructField("id", docs.schema[id_col].dataType), StructField("label", IntegerType()),
         StructField("at", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType()))]))
    found = found.orderBy(F.xxhash64("id"), "id", F.xxhash64("at", "value")).limit(max_rows).toArrow()
    pairs = list(zip((np.asarray(x.values) for x in found.column("at").combine_chunks()),
                     (np.asarray(x.values) for x in found.column("value").combine_chunks()))) if found.num_rows else []
    return FactorisationMachine.fit(pairs, found.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a column ``into``, the model's score of each whole text."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t) for t in byte_values(b.column(at))]
            scores = model.score(dense(got)) if got else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def op3_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the operator: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
