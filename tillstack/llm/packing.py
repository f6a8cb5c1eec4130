"""Best-fit decreasing packing of tokenised documents (operator 8).

Documents become byte-level BPE ids and an end id; those longer than a
sequence are cut into pieces of ``capacity`` ids, the first of which may be
shorter.  Pieces are packed by best-fit decreasing over the whole corpus: in
order of falling length each goes to the open sequence that has the least room
it still fits.  A segment tree over the remaining capacities finds that
sequence in logarithmic time.

Lengths are whole numbers of at most ``capacity``, so the counts of each length
(``capacity`` numbers, whatever the corpus) say all that best-fit decreasing
looks at.  The driver lays out the sequences from these counts, equal lengths
together; Spark numbers the pieces of each length and looks up their places.
The result is that of best-fit decreasing over all pieces one by one.

Edge cases: null and empty texts are one piece that holds the end id alone;
repeated rows are packed as often as they occur; a null id stays null; very
long texts and very long words are tokenised whole; an empty table gives no
rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from tillstack.llm.common import small_batches, stored

CAPACITY, END_ID = 2048, 0
#: Pieces of one length that are numbered in one task.
CELL = 256
#: The split pattern's ASCII-and-Unicode form is the vocabulary's own; words beyond this length go to
#: the other library, whose merges do not slow down with the square of a word's length.
LONG_WORD = 2000


def byte_alphabet() -> dict[str, int]:
    """The vocabulary file's character for each byte: printable ones stand for
    themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids of a byte-level BPE vocabulary file of the ``tokenizers`` library.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``;
    tests compare them.  Merges run in ``tiktoken``, which is five times faster
    on the same ranks (a token's rank is its id).
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        special = {t["content"]: t["id"] for t in held["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in held["model"]["vocab"].items() if token not in special}
        self._fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = set(special)
        self._whole = Tokenizer.from_file(path)
        self._long = re.compile(r"\S{%d}|\s{%d}" % (LONG_WORD, LONG_WORD))

    def ids(self, text: str) -> np.ndarray:
        if self._long.search(text):
            return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._fast.encode_to_numpy(text, allowed_special=self._special)


_PIECES = [StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", IntegerType()),
           StructField("ids", BinaryType())]


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(id, piece, start, length, ids)``: each document's ids and the end id, cut
    into pieces; ``ids`` are little-endian unsigned 32-bit integers."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(tokenizer)
        for b in batches:
            rows, pieces, starts, lengths, ids = [], [], [], [], []
            for r, value in enumerate(b.column(1)):
                got = np.append(bpe.ids(value.as_py() or ""), np.uint32(end_id)).astype("<u4")
                n = -(-len(got) // capacity)
                edges = [0, *(len(got) - capacity * i for i in range(n - 1, -1, -1))]
                for p in range(n):
                    rows.append(r)
                    pieces.append(p)
                    starts.append(edges[p])
                    lengths.append(edges[p + 1] - edges[p])
                    ids.append(got[edges[p]:edges[p + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int32()), pa.array(ids, pa.binary())], ["id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, StructType([StructField("id", docs.schema[id_col].dataType), *_PIECES]))


class RoomTree:
    """A segment tree over remaining capacities: which of them have open sequences."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, room: int, has: bool) -> None:
        i = room + self.leaves
        self.open[i] = has
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that has open sequences."""
        i = length + self.leaves
        if self.open[i]:
            return length
        while i > 1 and (i % 2 or not self.open[i + 1]):
            i //= 2
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_layout(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Best-fit decreasing over ``counts[length]`` pieces.

    For each length: runs ``(first, end, sequence, each, offset)``; the pieces
    numbered first <= i < end lie in ``sequence + (i - first) // each`` at
    ``offset + (i - first) % each * length``.
    """
    tree, rooms, new = RoomTree(capacity), [[] for _ in range(capacity + 1)], 0
    out: dict[int, list[tuple[int, int, int, int, int]]] = {}

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            rooms[room].append((first, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, done, runs = counts[length], 0, out.setdefault(length, [])
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, new, -(-left // (capacity // length))
                new += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.mark(room, False)
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((done, done + full * each, first, each, capacity - room))
                done, left = done + full * each, left - full * each
                put(room - each * length, first, full)
            if full < n and 0 < left < each:  # the last of this length share one sequence
                runs.append((done, done + left, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, n - full)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, cell: int = CELL, order: tuple = ("id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``."""
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    runs = StructType([StructField(c, LongType()) for c in ("first", "end", "sequence", "each", "offset")])
    plan = spark.createDataFrame(
        [(n, -(-counts[n] // cell), found) for n, found in best_fit_layout(counts, capacity).items()],
        StructType([StructField("length", IntegerType()), StructField("cells", IntegerType()), StructField("runs", ArrayType(runs))]))
    # the plan has at most `capacity` rows, so both joins with it are broadcast
    dealt = (pieces.join(F.broadcast(plan.select("length", "cells")), "length")
             .withColumn("cell", F.pmod(F.xxhash64(*order), F.col("cells")).cast("int")).drop("cells"))
    sizes = dealt.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "cell", F.coalesce(F.sum("n").over(
        W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = (dealt.withColumn("nth", F.row_number().over(W.partitionBy("length", "cell").orderBy(*order)) - 1)
                .join(before, ["length", "cell"]).withColumn("i", F.col("before") + F.col("nth")))
    placed = (numbered.join(F.broadcast(plan.select("length", "runs")), "length")
              .withColumn("run", F.expr("filter(runs, r -> r.first <= i AND i < r.end)[0]")))
    return (placed.withColumn("sequence_id", F.expr("run.sequence + (i - run.first) div run.each"))
            .withColumn("offset", F.expr("run.offset + (i - run.first) % run.each * length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def op8_packing(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The digest of the operator: each piece's ids as CRC-32, and its place."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return (pack(stored(pieces, "pieces")).withColumnRenamed("id", "doc_id")
            .select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                    F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset")))
