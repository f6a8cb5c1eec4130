"""Exact top-k search by pivot-table elimination (operator 6).

Scores are inner products of whole-number vectors floor(scale * x).  For a query
q and a candidate c, |q - c|^2 = |q|^2 + |c|^2 - 2 q.c, and for every pivot p
the triangle inequality gives |q - c| >= | |q - p| - |c - p| |.  The largest of
these lower bounds over all pivots is an upper bound of the score.  Distances to
the pivots are computed once for each vector (the pivot table).  A query takes
its candidates in the order of their bounds and stops when the next bound is
below its k-th score; equal scores go to the smaller id, so an equal bound is
still evaluated.  Bounds carry a margin for rounding; scores are exact.

Every vector belongs to the cell of its nearest pivot (there are about as many
cells as blocks of ``block`` vectors, at most one for each pivot).  A query starts
with the k-th score among a bounded sample, which no final k-th score is below, and
is sent only to the cells that can reach it: a cell's bound comes from the least and
the greatest distance of its vectors to each pivot.  Queries of neighbouring cells
travel together, and a candidate is sent only to groups of queries that one of them
sends to its cell.  Where queries and candidates meet, there are at most about
``block`` candidates and ``query_block`` queries, whatever the table's size; k rows
come back for each query.

Edge cases: vectors that are null or hold null or non-finite components take no
part; vectors of different length do not meet; rows that repeat id and vector
count once; an id with different vectors is a query for each, and none of its
rows is its own candidate; a null id is no query, and as a candidate it comes
last among equal scores; an empty table gives no rows.  Scores are computed in
doubles, exactly as long as no vector's square sum is beyond 2^53 (components of
some 10^5 in 64 dimensions); a vector beyond it raises an error that names this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pyspark.sql.pandas.types import to_arrow_type

from tillstack.llm.common import stored

K, SCALE, PIVOTS, SAMPLE = 5, 256, 64, 2048
BLOCK, QUERY_BLOCK, STEP = 4096, 2048, 128
#: Up to here whole numbers and their sums are exact in doubles.
EXACT = float(1 << 53)


def whole_vectors(table: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, dim, v)`` of the vectors that take part, once each; v is array<long>."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.pow(F.abs(F.lit(scale) * x.cast("double")) + 1, F.lit(2.0)))
    beyond = F.raise_error(F.lit(f"a vector times {scale} has a square sum beyond 2^53: scores would not be exact")).cast("array<bigint>")
    return (table.filter(F.col(vector).isNotNull() & good)
            .select(F.col(id_col).alias("id"), F.size(vector).alias("dim"), F.when(squares > EXACT, beyond).otherwise(whole).alias("v")).distinct())


def sample_of(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, tuple[list, np.ndarray]]:
    """Ids and vectors, for each dimension, of the at most ``sample`` vectors with the least hash."""
    some = vectors.orderBy(F.xxhash64("v"), "id").limit(sample).select("id", "dim", "v").collect()
    held: dict[int, list] = {}
    for r in some:
        held.setdefault(r.dim, []).append(r)
    return {dim: ([r.id for r in rows], np.array([r.v for r in rows], float).reshape(-1, dim)) for dim, rows in held.items()}


def choose_pivots(x: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Farthest-first: the first vector, then always the one farthest from those chosen."""
    picks, far = [0], np.linalg.norm(x - x[0], axis=1)
    while len(picks) < min(pivots, len(x)):
        picks.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(x - x[picks[-1]], axis=1))
    return x[picks]


def _stack(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim).astype(float)


def _best(q: np.ndarray, q_far: np.ndarray, q_ids: list, c: np.ndarray, c_far: np.ndarray, c_ids: np.ndarray,
          last: np.ndarray, k: int, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, the best candidates' numbers and scores; none below ``least`` is wanted."""
    q2, c2 = (q * q).sum(axis=1), (c * c).sum(axis=1)
    for i in range(len(q)):
        low = np.abs(c_far - q_far[i]).max(axis=1) if c_far.shape[1] else np.zeros(len(c))
        bound = (q2[i] + c2 - low * low) / 2
        bound += 1e-6 * (1 + np.abs(bound) + q2[i] + c2)
        own = (c_ids == q_ids[i]) & ~last
        bound[own] = -np.inf
        order, done = np.argsort(-bound, kind="stable"), 0
        rows, scores, size = np.empty(0, np.int64), np.empty(0), STEP
        while done < len(order) - own.sum():
            if bound[order[done]] < max(least[i], scores[-1] if len(rows) == k else -np.inf):
                break
            some = order[done:min(done + size, len(order) - int(own.sum()))]
            rows, scores = np.concatenate((rows, some)), np.concatenate((scores, c[some] @ q[i]))
            top = np.lexsort((c_ids[rows], last[rows], -scores))[:k]
            rows, scores, done, size = rows[top], scores[top], done + len(some), 2 * size
        yield i, rows, scores


class Cells:
    """What is known of the pivots' cells: for each (dimension, cell) the number of vectors, the
    bounds of their distances to the pivots and their greatest square sum.  At most one entry for each pivot."""

    def __init__(self, rows) -> None:
        by_dim: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r.dim, r.cell)):
            by_dim.setdefault(r.dim, []).append(r)
        self.sizes = {(r.dim, r.cell): r.n for rs in by_dim.values() for r in rs}
        self.bounds = {d: (np.array([r.cell for r in rs]), np.array([r.low for r in rs], float), np.array([r.high for r in rs], float),
                           np.array([r.most for r in rs], float)) for d, rs in by_dim.items()}

    def reached(self, dim: int, v: np.ndarray, far: np.ndarray, least: float) -> list[int]:
        """The cells that can hold a score of ``least`` or more for a query."""
        if dim not in self.bounds:
            return [0]
        cells, low, high, most = self.bounds[dim]
        gap = np.maximum(0, np.maximum(low - far, far - high)).max(axis=1)
        q2 = float(v @ v)
        bound = (q2 + most - gap * gap) / 2
        return cells[bound + 1e-6 * (1 + np.abs(bound) + q2 + most) >= least].tolist()


def query_groups(counts: dict[tuple[int, int], int], size: int) -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """The group that each (dimension, cell)'s queries travel in, and each group's number of
    parts.  Cells next to each other share a group of at most ``size`` queries."""
    out, held, dim = {}, [], None
    for (d, cell), n in sorted(counts.items()):
        if d != dim or held[-1] + n > size:
            held.append(0)
        held[-1] += n
        out[d, cell], dim = len(held) - 1, d
    return out, {g: max(1, -(-n // size)) for g, n in enumerate(held)}


def top_k(table: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, query, rank, id, score)``: the k best candidates of each row
    where ``is_query`` (of column ``id``) holds; ``query`` is the hash of its vector."""
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, id_col, vector, scale), "vectors")
    sample = sample_of(vectors)
    pivots = {dim: choose_pivots(x) for dim, (_, x) in sample.items()}
    total = vectors.count()
    in_use = max(1, -(-total // block))  # as many cells as blocks, where there are pivots enough

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far, cell, least = [], [], []
            for key, dim, v, asked in zip(*(b.column(c).to_pylist() for c in ("id", "dim", "v", "is_q"))):
                v = np.asarray(v, float)
                d = np.linalg.norm(pivots[dim] - v, axis=1) if dim in pivots else np.empty(0)
                far.append(d.tolist())
                cell.append(int(d[:in_use].argmin()) if len(d) else 0)
                kth = None
                if asked and dim in sample:
                    ids, x = sample[dim]
                    scores = (x @ v)[np.array([i != key for i in ids], bool)]
                    kth = float(np.sort(scores)[-k]) if len(scores) >= k else None
                least.append(kth)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(far, pa.list_(pa.float64())), pa.array(cell, pa.int32()),
                                              pa.array(least, pa.float64())], [*b.schema.names, "far", "cell", "least"])

    kind = vectors.schema["id"].dataType.simpleString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    base = vectors.select("*", F.coalesce(is_query, F.lit(False)).alias("is_q"),
                          F.pmod(F.xxhash64("id", "v"), F.lit(1 << 31)).alias("h"), F.xxhash64("v").alias("mark"))
    row = f"id {kind}, dim int, v array<long>, is_q boolean, h long, mark long, far array<double>, cell int, least double"
    table_rows = stored(base.mapInArrow(distances, row), "pivot-table")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for dim, v, far, c in zip(*(b.column(x).to_pylist() for x in ("dim", "v", "far", "cell"))):
                far, square = np.asarray(far, float), float(np.square(np.asarray(v, float)).sum())
                n, low, high, most = held.get((dim, c), (0, far, far, 0.0))
                held[dim, c] = n + 1, np.minimum(low, far), np.maximum(high, far), max(most, square)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in held], pa.int32()), pa.array([c for _, c in held], pa.int32()), pa.array([x[0] for x in held.values()], pa.int64()),
                 *(pa.array([x[i].tolist() for x in held.values()], pa.list_(pa.float64())) for i in (1, 2)),
                 pa.array([x[3] for x in held.values()], pa.float64())], ["dim", "cell", "n", "low", "high", "most"])

    def least_of(of: str, best) -> Column:  # place by place over the tasks' rows
        return F.aggregate(F.slice(of, 2, 1 << 30), F.get(of, 0), lambda a, x: F.zip_with(a, x, lambda y, z: best(y, z))).alias(of)

    known = table_rows.filter(F.col("dim").isin(list(pivots)))  # of other lengths there is one cell without bounds
    cells = Cells(known.mapInArrow(bounds, "dim int, cell int, n long, low array<double>, high array<double>, most double")
                  .groupBy("dim", "cell").agg(F.sum("n").alias("n"), F.max("most").alias("most"),
                                              F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
                  .select("dim", "cell", "n", "most", least_of("low", F.least), least_of("high", F.greatest)).collect())

    def targets(b: pa.RecordBatch) -> list[list[int]]:
        return [cells.reached(dim, np.asarray(v, float), np.asarray(far, float), -np.inf if least is None else least)
                for dim, v, far, least in zip(*(b.column(x).to_pylist() for x in ("dim", "v", "far", "least")))]

    def aims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("dim"), b.column("cell"), pa.array(targets(b), pa.list_(pa.int32()))], ["dim", "from", "to"])

    sent = (known.filter("is_q").mapInArrow(aims, "dim int, from int, to array<int>")
            .select("dim", "from", F.explode("to").alias("to")).groupBy("dim", "from", "to").count().collect())
    asks: dict[tuple[int, int], int] = {}
    for r in sent:  # at most pivots^2 rows of a length
        asks[r.dim, r["from"]] = max(asks.get((r.dim, r["from"]), 0), r["count"])
    groups, parts = query_groups(asks, query_block)
    meets: dict[tuple[int, int], set] = {}
    for r in sent:
        meets.setdefault((r.dim, r.to), set()).add(groups[r.dim, r["from"]])
    others = max(1, -(-table_rows.filter("is_q").count() // query_block))

    def blocks(dim: int, c: int) -> int:
        return max(1, -(-cells.sizes.get((dim, c), total) // block))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the places where they meet: cell and block of the candidates, group and part of the queries."""
        blocks = lambda dim, c: max(1, -(-cells.sizes.get((dim, c), total) // block))
        def made(b: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
            at, *new = zip(*out)
            some = b.select(["id", "dim", "v", "far", "least", "mark"]).take(pa.array(at))
            return pa.RecordBatch.from_arrays([*some.columns, pa.array(new[0], pa.bool_()), *(pa.array(x, pa.int32()) for x in new[1:])],
                                              [*some.schema.names, "q", "at_cell", "at_block", "at_group", "at_part"])

        def places(b: pa.RecordBatch) -> Iterator[tuple]:
            aimed = iter(targets(b.filter(b.column("is_q"))))
            for i, (dim, c, h, asked) in enumerate(zip(*(b.column(x).to_pylist() for x in ("dim", "cell", "h", "is_q")))):
                near = meets.get((dim, c), ()) if dim in pivots else [-1]
                yield from ((i, False, c, h % blocks(dim, c), g, p) for g in near for p in range(parts.get(g, others)))
                if asked:
                    group = groups[dim, c] if dim in pivots else -1
                    part = (h >> 8) % parts.get(group, others)
                    yield from ((i, True, to, x, group, part) for to in next(aimed) for x in range(blocks(dim, to)))

        for b in batches:
            out: list[tuple] = []
            for place in places(b):
                out.append(place)
                if len(out) == 2048:
                    yield made(b, out)
                    out = []
            if out:
                yield made(b, out)

    def cell(t: pa.Table) -> pa.Table:
        q, c = (t.filter(pc.equal(t["q"], x)) for x in (True, False))
        out = [[], [], [], []]
        if len(q) and len(c):
            dim = q["dim"][0].as_py()
            ids = c["id"].combine_chunks()
            c_ids, last = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
            qv, cv = (_stack(x["v"].combine_chunks(), dim) for x in (q, c))
            q_far, c_far = (np.array(x["far"].to_pylist(), float).reshape(len(x), -1) for x in (q, c))
            q_ids, marks = q["id"].to_pylist(), q["mark"].to_pylist()
            least = q["least"].combine_chunks().fill_null(-np.inf).to_numpy(zero_copy_only=False)
            for i, rows, scores in _best(qv, q_far, q_ids, cv, c_far, c_ids, last, k, least):
                out[0] += [q_ids[i]] * len(rows)
                out[1] += [marks[i]] * len(rows)
                out[2] += ids.take(pa.array(rows)).to_pylist()
                out[3] += scores.astype(np.int64).tolist()
        return pa.table([pa.array(x, t) for x, t in zip(out, (ids_kind, pa.int64(), ids_kind, pa.int64()))],
                        names=["query_id", "query", "id", "score"])

    ids_kind = to_arrow_type(vectors.schema["id"].dataType)
    met = (table_rows.mapInArrow(deal, f"id {kind}, dim int, v array<long>, far array<double>, least double, mark long, q boolean, "
                                       "at_cell int, at_block int, at_group int, at_part int")
           .groupBy("dim", "at_cell", "at_block", "at_group", "at_part")
           .applyInArrow(cell, f"query_id {kind}, query long, id {kind}, score long"))
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "query", "rank", "id", "score"))


def op6_topk(embeddings: DataFrame) -> DataFrame:
    """The digest of the operator: query_id, rank, vec_id, score."""
    return (top_k(embeddings, F.col("id") % 50 == 0)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
