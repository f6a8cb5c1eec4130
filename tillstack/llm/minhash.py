"""MinHash near-duplicates on word shingles (operator 12).

Two documents link if their shingle sets' similarity (Jaccard) reaches a
threshold in hundredths (85), tested in integers on the full sets.

1. Each *distinct* set gets 128 minima of universal hashes ``a x + b mod 2^64``:
   32 band keys of four minima each, and one byte of every minimum as signature.
2. Sets that share a band key meet in a bucket.  A breadth-first forest over
   those whose signatures agree in ``LEAST_EQUAL`` places or more gives edges, never
   all pairs; their connected components are the candidate groups.
3. Each group's sets, made again from the texts, meet once more.  A forest over
   the pairs that pass signature and size, and then the full sets, gives the links.
4. Links become components by alternating large-star and small-star rounds.

A link is lost only if no band agrees or the signatures differ too much: at the
threshold (0.85) 6e-11 and 3e-9 by these figures, less above it.  Shingles are
told apart by 64-bit hashes, sets by 128 bits.  Buckets of over ``block`` sets and
groups of over ``GROUP_BYTES`` of sets are cut into cells of two blocks each, so
no task holds a whole large group and no pair is missed.

Edge cases: sets without a word (null, empty, blank texts) link with nothing and
are their own component; a null id takes part, a component's id is its smallest
non-null one (null if there is none), and ``kept`` is never null; repeated rows
stay rows; rows of one id with other texts are told apart; an empty table gives
no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tillstack.llm.common import byte_values, small_batches, stored, tasks, text_key, word_chunks
from tillstack.llm.simhash import components

SHINGLE, PERCENT = 3, 85
BANDS, ROWS = 32, 4
LEAST_EQUAL = 82
BLOCK, GROUP_BYTES = 4096, 16 << 20
SEED = 42
_U64 = np.uint64
_KEY_BYTES, _SIG_BYTES = 8 * BANDS, BANDS * ROWS
_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), _U64) * _U64(2) + _U64(1)
_B = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), _U64)


def shingle_set(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted different hashes of a text's shingles; fewer words are one shingle."""
    h64, parts, tail = xxhash.xxh64_intdigest, [], []
    for words in word_chunks(data.lower()):
        words = tail + words
        if len(words) < size:
            tail = words
            continue
        tail = words[len(words) - size + 1:]
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - size + 1
        parts.append(np.unique(np.fromiter((h64(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())), _U64, n)))
    if not parts and tail:
        return np.array([h64(b" ".join(tail), SEED)], _U64)
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, _U64)


def minima(values: np.ndarray) -> np.ndarray:
    """The 128 minima of a set, 32 bits of each."""
    low = np.full(len(_A), ~_U64(0))
    for at in range(0, len(values), 2048):
        low = np.minimum(low, (_A * values[at:at + 2048] + _B).min(axis=1))
    return (low >> _U64(32)).astype(np.uint32)


def _band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key for every band, the band's number included."""
    four = np.ascontiguousarray(low).view(_U64).reshape(-1, BANDS, ROWS // 2)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15), four.shape[:2]).copy()
    for c in range(ROWS // 2):
        key = (key ^ four[:, :, c]) * _U64(0xBF58476D1CE4E5B9)
        key ^= key >> _U64(29)
    return key


def sketch(values: np.ndarray) -> bytes:
    """The band keys, then the signature."""
    low = minima(values)
    return _band_keys(low[None, :]).astype("<u8").tobytes() + low.astype(np.uint8).tobytes()


def sketches(docs: DataFrame, text: str, id_col: str, shingle: int) -> DataFrame:
    """``(id, text_key, n, set_key, sketch)`` for each row; an empty set has null keys."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, names, made = [], [], []
            for data in byte_values(b.column(2)):
                values = shingle_set(data, shingle)
                n.append(len(values))
                names.append(xxhash.xxh128_digest(values.astype("<u8").tobytes()) if len(values) else None)
                made.append(sketch(values) if len(values) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(names, pa.binary()),
                                              pa.array(made, pa.binary())], ["id", "text_key", "n", "set_key", "sketch"])

    return docs.select(F.col(id_col).alias("id"), text_key(F.col(text).cast("string")).alias("text_key"),
                       F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, text_key long, n long, set_key binary, sketch binary")


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by their first ``keys`` (long) columns, in tables of whole groups
    with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def bounds(t: pa.Table) -> np.ndarray:
        new = np.zeros(max(0, len(t) - 1), bool)
        for k in range(keys):
            c = t.column(k).to_numpy()
            new |= c[1:] != c[:-1]
        return np.concatenate(([0], np.flatnonzero(new) + 1, [len(t)]))

    for b in batches:
        if not b.num_rows:
            continue
        if held and all(held[-1].column(k)[-1] == b.column(k)[b.num_rows - 1] for k in range(keys)):
            held.append(b)  # still one group
            continue
        t = pa.Table.from_batches([*held, b])
        cut = bounds(t)
        if len(cut) > 2:
            yield t.slice(0, cut[-2]), cut[:-1]
        held = t.slice(cut[-2]).to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, bounds(t)


def _pairs(found: list) -> pa.RecordBatch:
    a = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["u", "v"])


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _candidates(least: int):
    """Forest edges of every bucket by the signatures: rows ``(key, cell, node, sig)``."""

    def forest(node: np.ndarray, sig: np.ndarray) -> list:
        found, left = [], np.arange(len(node))
        while len(left) > 1:
            front, left = left[:1], left[1:]
            while len(front) and len(left):
                by = np.full(len(left), -1)
                for at in range(0, len(front), 32):
                    part = front[at:at + 32]
                    equal = (sig[part][:, None, :] == sig[left][None, :, :]).sum(axis=2) >= least
                    by = np.where((by < 0) & equal.any(axis=0), part[equal.argmax(axis=0)], by)
                hit = by >= 0
                found += zip(node[by[hit]].tolist(), node[left[hit]].tolist())
                front, left = left[hit], left[~hit]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in _grouped(batches, 2):
            node, sig, found = t.column(2).to_numpy(), _matrix(t.column(3), _SIG_BYTES), []
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if e - s > 1:
                    found += forest(node[s:e], sig[s:e])
            if found:
                yield _pairs(found)

    return run


def _links(percent: int, least: int):
    """Forest edges of every group by the full sets: rows ``(root, cell, node, sketch, values)``."""

    def forest(node: np.ndarray, sig: np.ndarray, sets: list[np.ndarray]) -> list:
        size = np.array([len(x) for x in sets])
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        parts = np.split(ids, np.cumsum(size)[:-1])
        mark, found, left = np.zeros(len(ids), bool), [], np.arange(len(node))
        while len(left) > 1:
            front, left = [left[0]], left[1:]
            while front and len(left):
                x = front.pop()
                small, large = np.minimum(size[x], size[left]), np.maximum(size[x], size[left])
                pass_ = (100 * small >= percent * large) & ((sig[x] == sig[left]).sum(axis=1) >= least)
                near = left[pass_]
                if not len(near):
                    continue
                mark[parts[x]] = True
                shared = np.array([np.count_nonzero(mark[parts[y]]) for y in near.tolist()])
                mark[parts[x]] = False
                near = near[100 * shared >= percent * (size[x] + size[near] - shared)]
                found += [(int(node[x]), y) for y in node[near].tolist()]
                front += near.tolist()
                left = left[~np.isin(left, near)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in _grouped(batches, 2):
            nodes, found = t.column(2).to_numpy(), []
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                rows = s + np.unique(nodes[s:e], return_index=True)[1]  # repeated rows come once
                if len(rows) > 1:
                    some = t.take(pa.array(rows))
                    sets = [np.frombuffer(v, "<u8") for v in some.column(4).to_pylist()]
                    found += forest(nodes[rows], _matrix(some.column(3), _KEY_BYTES + _SIG_BYTES)[:, _KEY_BYTES:], sets)
            if found:
                yield _pairs(found)

    return run


def _dealt(rows: DataFrame, groups: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` joined with ``groups (key, cells)`` and dealt out: a row of a group of
    several cells goes to the cells (lower, higher) of its block and every other."""
    b = F.pmod(F.xxhash64("node"), F.col("cells"))
    one = F.lit(1 << 20).cast("long")
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1), lambda o: F.least(o, b) * one + F.greatest(o, b))
    placed = rows.join(groups, key).withColumn("cell", F.explode(every)).select(key, "cell", *columns)
    return placed.repartition(tasks(rows.sparkSession), key, "cell").sortWithinPartitions(key, "cell")


def candidate_groups(sets: DataFrame, block: int = BLOCK, least: int = LEAST_EQUAL) -> DataFrame:
    """``(node, root)`` of the sets that a chain of passing signatures joins; ``sets``: ``(node, sketch)``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = _matrix(pa.chunked_array([b.column(1)]), _KEY_BYTES + _SIG_BYTES)[:, :_KEY_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(key).view("<i8").ravel()),
                                              b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), BANDS)))], ["key", "node"])

    spark = sets.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    keyed = sets.select("node", "sketch").mapInArrow(keys, "key long, node long")
    shared = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                    .select("key", F.ceil(F.col("n") / block).cast("long").alias("cells")), "minhash-buckets")
    members = stored(keyed.join(shared.select("key"), "key", "left_semi"), "minhash-members")
    signed = members.join(sets.select("node", F.expr(f"substring(sketch, {_KEY_BYTES + 1}, {_SIG_BYTES})").alias("sig")), "node")
    edges = _dealt(signed, shared, "key", ["node", "sig"]).mapInArrow(_candidates(least), "u long, v long")
    return components(edges.distinct()).withColumnRenamed("fp", "node")


def set_links(docs: DataFrame, groups: DataFrame, text: str, id_col: str, shingle: int, percent: int, least: int,
              group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Links ``(u, v)`` that span each component of the graph on full sets; ``groups``:
    ``(root, node, n, id, text_key)``, a row of ``docs`` for each node."""
    sized = groups.groupBy("root").agg(F.ceil(8 * F.sum("n") / group_bytes).cast("long").alias("cells"))
    texts = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text).cast("string")).alias("_key"), F.col(text).cast("string").alias("text"))
    # the groups grow with the documents: one plan at every size, never a broadcast
    whole = texts.join(groups.hint("merge"), texts["_id"].eqNullSafe(groups["id"]) & (texts["_key"] == groups["text_key"])).select("root", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(data, shingle) for data in byte_values(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([sketch(x) for x in sets], pa.binary()),
                 pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())], ["root", "node", "sketch", "values"])

    small_batches(docs.sparkSession)
    made = whole.mapInArrow(run, StructType([StructField("root", LongType()), StructField("node", LongType()),
                                             StructField("sketch", BinaryType()), StructField("values", BinaryType())]))
    return _dealt(made, sized, "root", ["node", "sketch", "values"]).mapInArrow(_links(percent, least), "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT,
                    least: int = LEAST_EQUAL, block: int = BLOCK, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(id, n, component_id)`` for each row of ``docs``; see the module's notes.
    ``least`` belongs to the threshold: lower it with ``percent``."""
    rows = stored(sketches(docs, text, id_col, shingle), "minhash")
    least_row = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    first = stored(rows.filter("n > 0").groupBy("set_key").agg(least_row.alias("row"), F.max("n").alias("n"), F.max("sketch").alias("sketch"))
                   .select("set_key", "row.id", "row.text_key", "n", "sketch", F.monotonically_increasing_id().alias("node")), "minhash-sets")
    roots = stored(candidate_groups(first, block, least), "minhash-groups")
    groups = stored(first.join(roots, "node").select("root", "node", "n", "id", "text_key"), "minhash-sized")
    links = stored(set_links(docs, groups, text, id_col, shingle, percent, least, group_bytes).distinct(), "minhash-links")
    joined = stored(components(links).select(F.col("fp").alias("node"), "root"), "minhash-components")
    member = first.select("set_key", "id", "node").join(joined, "node", "left").select("set_key", "id", F.coalesce("root", "node").alias("root"))
    least_id = member.groupBy("root").agg(F.min("id").alias("component_id"))
    found = stored(member.join(least_id, "root").select("set_key", "component_id"), "minhash-ids")
    linked = rows.select("id", "n", "set_key").join(found, "set_key", "left")
    return linked.select("id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def op12_minhash(docs: DataFrame) -> DataFrame:
    """The digest of the operator: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_have FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
reached AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS c FROM reached GROUP BY u)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.c, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.c, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.u = d.doc_id
"""
