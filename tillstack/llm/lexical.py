"""Ranked lexical search by per-term geometric blocking (operator 11).

A document's score for an item is the sum, over the item's terms with repeats, of
``w * impact``: w comes from the share of documents that hold the term, the
impact from its occurrences and the document's length, all in 64-bit integers.

Documents are read once: each row keeps its number of terms and its counts of
the queried terms (a forward row).  N, L and the document frequencies are counted
over all of them.  Forward rows are dealt into shards of bounded size, and each
shard is searched where it lies:

- a term's posting list in the shard is clustered by similarity (the documents'
  impact vectors, projected to ``SKETCH`` numbers, go to the nearest of some pivots
  of the list) into blocks of about ``BLOCK`` documents;
- a block's summary is the coordinatewise maximum of its documents' impacts;
- an item's lists are taken by falling weight.  A document counts in the first of
  these lists that holds it, so a block's bound is the summary's product with the
  weights from that list on.  A block is skipped only if its bound is below the
  item's k-th best score so far; equal ones are evaluated, as ids break ties.  When
  even the lists' own maxima are below it, the rest of the lists is skipped.

The best k of each task are merged in two steps, so no task gets the rows of all.
Items are taken in groups of at most ``ITEM_TERMS`` different terms (or one item):
what is sent to the tasks is bounded by the items, not by the documents.  A shard
holds at most ``CELLS`` impacts.  Weights whose sums could pass 2^63 are an error.
Ids are integers.

Edge cases: null and empty texts hold no term and do not count; an item without
a term, or whose terms no document holds, has no rows; repeated rows each have a
rank; null ids come last among equal scores and stay null; repeated items are
searched each for itself; an empty table of either kind gives no rows; other
columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillstack.llm.common import byte_values, small_batches, stored, tasks

BEST, BLOCK, SHARD, SKETCH = 20, 128, 8192, 32
ITEM_TERMS, CELLS = 1 << 14, 1 << 24
_LAST = (1 << 63) - 1
#: Term signs are ASCII digits, letters (lower-cased) and every byte of other characters.
_SIGNS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return data.translate(_SIGNS).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1000000000 * tf) // (1000 * tf + 12 * m)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, n, terms, tfs)`` for each document with a term: its number of terms and
    the numbers and counts of those in ``vocabulary``."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = vocabulary.keys()
        for b in batches:
            rows, n, numbers, counts = [], [], [], []
            for r, data in enumerate(byte_values(b.column(1))):
                found = Counter(terms(data))
                if found:
                    known = sorted((vocabulary[t], found[t]) for t in asked & found.keys())
                    rows.append(r)
                    n.append(found.total())
                    numbers.append([t for t, _ in known])
                    counts.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                                             ["id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n long, terms array<int>, tfs array<long>")


class Shard:
    """Posting lists of some documents, blocked when an item first asks for them.

    ``lists``: for every term its documents' rows; ``impacts``: a row for each
    document, a column for each term that the shard holds."""

    def __init__(self, ids: np.ndarray, of: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray):
        self.ids = ids
        self.terms, column = np.unique(term, return_inverse=True)
        self.impacts = np.zeros((len(ids), len(self.terms)), np.int32)  # at most a million
        self.impacts[of, column] = impact(tf, m[of])
        order = np.argsort(column, kind="stable")
        self.lists = np.split(of[order], np.cumsum(np.bincount(column, minlength=len(self.terms)))[:-1]) if len(term) else []
        self.most = self.impacts.max(axis=0).astype(np.int64)
        turn = np.random.default_rng(11).standard_normal((len(self.terms), SKETCH), np.float32)
        self.sketch = self.impacts.astype(np.float32) @ turn
        self.blocks: dict[int, tuple] = {}
        self.evaluated = 0

    def blocked(self, column: int, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A list's documents block by block, the blocks' starts, and their summaries over the columns ``asked``."""
        if column not in self.blocks:
            rows = self.lists[column]
            count = -(-len(rows) // BLOCK)
            starts = np.zeros(1, np.int64)
            if count > 1:
                pivots = self.sketch[rows[np.linspace(0, len(rows) - 1, count).astype(np.int64)]]
                near = (self.sketch[rows] @ pivots.T * 2 - (pivots * pivots).sum(axis=1)).argmax(axis=1)
                order = np.argsort(near, kind="stable")
                rows, near = rows[order], near[order]
                starts = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
            self.blocks[column] = rows, starts, np.maximum.reduceat(self.impacts[np.ix_(rows, asked)], starts, axis=0)
        return self.blocks[column]

    def search(self, items: list[tuple[np.ndarray, np.ndarray]], asked: list[np.ndarray], best: list[tuple], k: int) -> None:
        """Improve ``best`` (scores and ids of every item) by this shard's documents.
        ``items``: term numbers and weights by falling weight; ``asked``: for every
        term the terms of the items that hold it."""
        where = {t: c for c, t in enumerate(self.terms.tolist())}
        columns_of: dict[int, tuple] = {}
        seen = np.zeros(len(self.ids), np.int64)
        for number, (item, weights) in enumerate(items):
            have = [(where[t], w) for t, w in zip(item.tolist(), weights.tolist()) if t in where and w > 0]
            if not have:
                continue
            column, w = (np.array(x, np.int64) for x in zip(*have))
            rest = np.cumsum((w * self.most[column])[::-1])[::-1]
            scores, ids = best[number]
            for j, c in enumerate(column.tolist()):
                least = scores[-1] if len(scores) == k else 1
                if rest[j] < least:
                    break
                if c not in columns_of:
                    columns_of[c] = np.array([where[t] for t in asked[self.terms[c]].tolist() if t in where], np.int64)
                rows, starts, summary = self.blocked(c, columns_of[c])
                bounds = summary[:, np.searchsorted(columns_of[c], column[j:])] @ w[j:]
                order = np.argsort(-bounds, kind="stable")
                ends = np.append(starts[1:], len(rows))
                for block in order.tolist():
                    if bounds[block] < (scores[-1] if len(scores) == k else 1):
                        break
                    some = rows[starts[block]:ends[block]]
                    some = some[seen[some] != number + 1]
                    seen[some] = number + 1
                    self.evaluated += len(some)
                    got = self.impacts[np.ix_(some, column)] @ w
                    keep = got >= (scores[-1] if len(scores) == k else 1)
                    if keep.any():
                        scores, ids = np.concatenate((scores, got[keep])), np.concatenate((ids, self.ids[some[keep]]))
                        order_ = np.lexsort((ids, -scores))[:k]
                        scores, ids = scores[order_], ids[order_]
            best[number] = scores, ids


def _search(items: list[tuple], asked: list[np.ndarray], n_docs: int, n_terms: int, k: int, shard: int):
    """Forward rows to the task's best rows: ``(item, place, score)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.int64)
        best = [(empty, empty)] * len(items)
        held: list[pa.RecordBatch] = []

        def searched() -> None:
            t = pa.Table.from_batches(held)
            ids, size = t.column(0).to_numpy(), t.column(1).to_numpy()
            lists, tfs = (t.column(c).combine_chunks() for c in (2, 3))
            each = lists.value_lengths().to_numpy()
            m = 100 - 25 + (25 * size * n_docs) // n_terms
            Shard(ids, np.repeat(np.arange(len(ids)), each), lists.flatten().to_numpy(), tfs.flatten().to_numpy(), m).search(
                items, asked, best, k)

        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(h.num_rows for h in held) >= shard:
                searched()
                held.clear()
        if held:
            searched()
        sizes = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(items)), sizes), pa.int64()), pa.array(np.concatenate([i for _, i in best] or [empty]), pa.int64()),
             pa.array(np.concatenate([s for s, _ in best] or [empty]), pa.int64())], ["item", "place", "score"])

    return run


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("place"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def item_groups(items: DataFrame, text: str, id_col: str) -> Iterator[list[tuple]]:
    """The items, ``(id, counted terms)``, in groups of bounded vocabulary; they come to the driver one after another."""
    held, known = [], set()
    for r in items.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).toLocalIterator():
        found = Counter(terms((r.text or "").encode()))
        if held and len(known | found.keys()) > ITEM_TERMS:
            yield held
            held, known = [], set()
        held.append((r.id, found))
        known |= found.keys()
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
           item_id: str = "item_id", shard: int = SHARD) -> DataFrame:
    """``(item, rank, id, score)``: each item's ``k`` best documents; see the module's notes."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"item {items.schema[item_id].dataType.simpleString()}, rank int, "
                                    f"id {docs.schema[id_col].dataType.simpleString()}, score long")
    for group in item_groups(items, item_text, item_id):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in group for t in found}))}
        forward = stored(forward_rows(docs, vocabulary, text, id_col), "lexical-forward")
        total = forward.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        if not total.n or not vocabulary:
            continue
        df = {r.t: r.df for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
        made, asked = [], [set() for _ in vocabulary]
        for _, found in group:
            held = sorted(((vocabulary[t], c * weight(total.n, df.get(vocabulary[t], 0))) for t, c in found.items()), key=lambda x: (-x[1], x[0]))
            if sum(w for _, w in held) * 1000000 > _LAST:
                raise ValueError("an item's scores can pass 64 bits")
            made.append((np.array([t for t, _ in held], np.int64), np.array([w for _, w in held], np.int64)))
            for t, _ in held:
                asked[t].update(made[-1][0].tolist())
        columns = [np.array(sorted(a), np.int64) for a in asked]
        # ids keep their own column: places order them, null last
        placed = forward.select(F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("place"), "n", "terms", "tfs")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        found = placed.mapInArrow(_search(made, columns, total.n, total.l, k, min(shard, max(64, CELLS // len(vocabulary)))), "item long, place long, score long")
        salted = found.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(max(1, math.isqrt(tasks(spark))))))
        best = stored(_best(_best(salted, ["item", "salt"], k).drop("rank"), ["item"], k), "lexical-best")
        names = spark.createDataFrame([(i, ident) for i, (ident, _) in enumerate(group)],
                                      f"item long, name {items.schema[item_id].dataType.simpleString()}")
        out = out.unionByName(best.join(names, "item").select(
            F.col("name").alias("item"), "rank", F.when(F.col("place") != _LAST, F.col("place")).cast(docs.schema[id_col].dataType).alias("id"), "score"))
    return out


def op11_lexical(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of the operator: item_id, rank, doc_id, score."""
    return ranked(docs, benchmark).select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


SQL = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t),
counts AS (SELECT doc_id, t, count(*) AS tf FROM found WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM counts GROUP BY t), total),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN counts USING (t) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""
