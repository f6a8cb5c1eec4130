"""Document fingerprints by winnowing (operator 10).

A rolling hash of every ``k`` consecutive code points; of every ``window``
consecutive hashes the smallest is chosen, the rightmost of equal ones, and
kept with its position.  So two texts that share ``k + window - 1`` consecutive
code points share a chosen hash.  A text with fewer hashes has one window, a
text shorter than ``k`` one hash of all of it, an empty text none.

Grams of 8 and windows of 16, at every text size, make a shared hash sure from 23
code points on, so that short texts that share half of their characters share one.

``with_next`` gives each document its successor by ascending id: the rows are
cut into ranges of ids, each range also gets the first row of the next one,
and each is read in order, so no task sees all rows and the text moves once.

Edge cases: null texts count as empty; two empty texts are alike (1), an empty
and a non-empty one are not (0); equal ids are ordered by the hash of their
text, null ids come last; repeated rows follow one another; a table of one row
is its own successor; very long texts are hashed in pieces; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType)

from tillstack.llm.common import small_batches, tasks, text_key

GRAM, WINDOW = 8, 16
_BLOCK = 1 << 18
_U64 = np.uint64
_LOW = (1 << 24) - 1
_LAST = (1 << 63) - 1


def _grams(points: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash of every ``k`` (a power of two) code points, well mixed."""
    h, base, width = points.astype(_U64) + _U64(1), 0x9E3779B97F4A7C15, 1
    while width < k:
        h, base, width = h[:-width] * _U64(base) + h[width:], base * base % (1 << 64), 2 * width
    h = (h ^ (h >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U64(29))


def fingerprint(text: str, k: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """The chosen hashes (32 bits) and positions, a row for each, in order of position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.empty((0, 2), np.uint32)
    if len(points) < k:
        whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
        return np.array([[int.from_bytes(whole[:4], "big"), 0]], np.uint32)
    found, last = [], -1
    n = max(1, len(points) - k - window + 2)  # windows
    for at in range(0, n, _BLOCK):
        some = min(_BLOCK, n - at)
        h = _grams(points[at:at + some + window + k - 2], k)
        value = (h & _U64(~_LOW & (2**64 - 1))) | (_U64(_LOW) - np.arange(len(h), dtype=_U64))
        if len(value) < window:
            low = value.min(keepdims=True)
        else:
            low, width = value, 1
            while 2 * width <= window:
                low, width = np.minimum(low[:-width], low[width:]), 2 * width
            low = np.minimum(low[:len(low) - (window - width)], low[window - width:])
        low = low[np.concatenate(([True], low[1:] != low[:-1]))]
        place = at + (_U64(_LOW) - (low & _U64(_LOW))).astype(np.int64)
        new = place > last
        if new.any():
            found.append(np.stack((low[new] >> _U64(32), place[new].astype(_U64)), axis=1).astype(np.uint32))
            last = int(place[-1])
    return np.concatenate(found)


def as_text(chosen: np.ndarray) -> str:
    """Sixteen hex digits for each chosen hash: the hash and its position."""
    return chosen.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share (Jaccard) of two fingerprints' hashes; positions play no part."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    x, y = np.unique(a[:, 0]), np.unique(b[:, 0])
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / (len(x) + len(y) - shared)


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``(id, hashes, positions)`` for each row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprint(v.as_py() or "", k, window) for v in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([g[:, i].astype(np.int64) for g in got], pa.list_(pa.int64())) for i in (0, 1))],
                ["id", "hashes", "positions"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, row, schema: StructType, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row ``(id, *row(state, state of the next document))`` for each document.

    ``row.start(text)`` makes a document's state, ``row(this, next)`` the values
    after the id; ``schema`` is that of the result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = 4 * tasks(spark)
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    keyed = docs.select(F.col(id_col).alias("id"), place.alias("place"), text_key(F.col(text)).alias("key"),
                        F.col(text).cast("string").alias("text"))
    cuts = keyed.select(F.col("place").cast("double").alias("p")).approxQuantile("p", [i / n for i in range(1, n)], 1 / (4 * n))
    cuts = np.unique(np.asarray(cuts, float))  # at most n numbers

    def part(places: pa.Array) -> np.ndarray:
        return np.searchsorted(cuts, places.to_numpy().astype(float), side="right").astype(np.int32)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part(b.column(0))), b.column(0), b.column(1)], ["part", "place", "key"])

    firsts = (keyed.select("place", "key").mapInArrow(parts, "part int, place long, key long").groupBy("part")
              .agg(F.min(F.struct("place", "key")).alias("row")).orderBy("part").collect())  # a row for each range
    order = [r.part for r in firsts]
    guests = {(r.row.place, r.row.key): order[i - 1] for i, r in enumerate(firsts)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, whole = part(b.column(1)), [*b.columns]
            names = ["part", "guest", *b.schema.names]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.zeros(len(at), bool)), *whole], names)
            visits = [(i, guests[x]) for i, x in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())) if x in guests]
            if visits:
                rows = pa.array([i for i, _ in visits])
                yield pa.RecordBatch.from_arrays([pa.array([p for _, p in visits], pa.int32()), pa.array([True] * len(visits)),
                                                  *(c.take(rows) for c in whole)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, in_part = None, None
        for b in batches:
            out = []
            for p, guest, ident, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(5)):
                if p != in_part:
                    held, in_part = None, p
                elif held is None:
                    continue  # a second guest: a repeated row
                state = row.start(value.as_py() or "")
                if held is not None:
                    out.append((held[0], *row(held[1], state)))
                held = None if guest else (ident, state)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], schema.names)

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    laid = keyed.mapInArrow(dealt, StructType([StructField("part", IntegerType()), StructField("guest", BooleanType()), *keyed.schema.fields]))
    return laid.repartition(n, "part").sortWithinPartitions("part", "guest", "place", "key").mapInArrow(walk, schema)


class Edited:
    """A document against its edited text and its successor."""

    def start(self, text: str):
        return text, fingerprint(text)

    def __call__(self, this, after):
        text, chosen = this
        half = len(text) // 2
        edited = text[:len(text) - half] + after[0][:half]
        changed = fingerprint(edited)
        return (len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(chosen), as_text(changed),
                likeness(chosen, changed), likeness(chosen, after[1]))


def op10_winnowing(docs: DataFrame) -> DataFrame:
    """The digest of the operator; ``fingerprint`` is ``as_text`` of the chosen hashes and positions."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_chars", LongType()),
                         StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
                         StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()),
                         StructField("near_next", DoubleType())])
    return with_next(docs, Edited(), schema)
