"""SimHash near-duplicates with a pigeonring filter (operator 2).

A document's fingerprint has 64 bits; two fingerprints link at ``max_bits``
(3) or fewer differing bits.  The 64 bits form a ring of four segments of 16.
If two fingerprints differ in at most 3 bits then from some segment on every
chain of 1, 2, 3, 4 consecutive segments differs in at most floor(3 l / 4) =
0, 1, 2, 3 bits.  So candidates agree in one segment and differ in at most one
bit of the next: both lie under one 32-bit key if the side with the bit set
also enters under the key with that bit cleared.  The third chain is tested
before the full distance.

What crosses the network is one row for each key of a *distinct* fingerprint.
A bucket yields a spanning forest of its links, never all its pairs; a bucket
with over ``block`` fingerprints is cut into cells of two blocks each.

Edge cases: null and empty texts have fingerprint 0 and link like any other;
repeated rows stay rows; rows with a null id take part and a group's id is its
smallest non-null one (null if there is none); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tillstack.llm.common import byte_values, small_batches, stored, tasks, word_chunks

SHINGLE, MAX_BITS, BLOCK = 3, 3, 4096
SEED = 42
_U64 = np.uint64


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half of the shingles' XXH64."""
    h64 = xxhash.xxh64_intdigest
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for words in word_chunks(data.lower()):
        words = tail + words
        tail = words[1 - shingle:] if shingle > 1 else []
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        if len(words) < shingle:
            tail = words
            continue
        starts = np.concatenate(([0], ends[:-1] + 1))
        pairs = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        h = np.fromiter((h64(joined[a:b], SEED) for a, b in pairs), _U64, len(words) - shingle + 1)
        for at in range(0, len(h), 8192):
            bits = np.unpackbits(h[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    if not n and tail:
        return h64(b" ".join(tail), SEED)
    if not n:
        return 0
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, id_col: str = "doc_id",
                 row_key: Column | None = None) -> DataFrame:
    """``(id, key, fp)`` for each row; fp is the fingerprint as a signed long, key
    is ``row_key`` (a string expression), or null."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in byte_values(b.column(2))), _U64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["id", "key", "fp"])

    key = (F.lit(None) if row_key is None else row_key).cast("string").alias("key")
    return docs.select(F.col(id_col).alias("id"), key, F.col(text).cast("string").alias("text")).mapInArrow(
        run, StructType([StructField("id", kind), StructField("key", StringType()), StructField("fp", LongType())]))


_KEYED = StructType([StructField("seg", IntegerType()), StructField("key", LongType()),
                     StructField("fp", LongType()), StructField("probe", BooleanType())])


def _ring(fp: np.ndarray, seg: int) -> np.ndarray:
    """The fingerprint turned so that segment ``seg`` comes first."""
    r = _U64(16 * seg)
    return fp if not seg else (fp << r) | (fp >> (_U64(64) - r))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(_U64)
        for seg in range(4):
            key = _ring(fp, seg) >> _U64(32)
            keys, owners, probes = [key], [fp], [np.zeros(len(fp), bool)]
            for bit in range(16):
                on = (key >> _U64(bit)) & _U64(1) == 1
                keys.append(key[on] ^ _U64(1 << bit))
                owners.append(fp[on])
                probes.append(np.ones(int(on.sum()), bool))
            key, own = np.concatenate(keys), np.concatenate(owners)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), seg, np.int32)), pa.array(key.view(np.int64)),
                 pa.array(own.view(np.int64)), pa.array(np.concatenate(probes))], ["seg", "key", "fp", "probe"])


def _near(seg: int, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs pass the chains and then the full distance; rows a, columns b."""
    x = _ring(a, seg)[:, None] ^ _ring(b, seg)[None, :]
    three = np.bitwise_count(x >> _U64(16)) <= 2  # the first chain is the key, the second at most 1 by the key
    out = np.zeros(x.shape, bool)
    out[three] = np.bitwise_count(x[three]) <= max_bits
    return out


def _forest(seg: int, own: np.ndarray, max_bits: int) -> tuple[list, np.ndarray]:
    """Breadth-first forest over the bucket's own fingerprints: edges, and each one's root."""
    root = own.copy()
    left = np.arange(len(own))
    while len(left):
        front, left, top = left[:1], left[1:], own[left[0]]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                hit |= _near(seg, own[front[at:at + 256]], own[left], max_bits).any(axis=0)
            front, left = left[hit], left[~hit]
            root[front] = top
    far = root != own
    edges = list(zip(root[far].tolist(), own[far].tolist()))
    return edges, root


def _links(max_bits: int):
    """Edges of each bucket; rows come sorted by bucket, its own fingerprints before the probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        open_key, own, root = None, None, None

        def made(pairs: list) -> pa.RecordBatch:
            a = np.array(pairs, _U64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0].view(np.int64)), pa.array(a[:, 1].view(np.int64))], ["u", "v"])

        def flush(cols: list[np.ndarray], last: bool) -> tuple[list, list[np.ndarray] | None]:
            """The edges of all buckets but a last one of whose own rows more may follow; that one's rows."""
            nonlocal open_key, own, root
            seg, key, cell, fp, probe = cols
            cut = np.flatnonzero((seg[1:] != seg[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(seg)]))
            pairs: list = []
            rest = None
            some = (ends - starts > 1) & ~probe[starts]  # a lone row or probes alone make no link
            some[0] = some[-1] = True
            for s, e in zip(starts[some].tolist(), ends[some].tolist()):
                me = (seg[s], key[s], cell[s])
                if e == len(seg) and not last and not probe[e - 1]:
                    rest = [c[s:e] for c in cols]  # more of its own may follow
                    break
                if me != open_key:
                    mine = ~probe[s:e]
                    own = np.unique(fp[s:e][mine])
                    got, root = _forest(int(seg[s]), own, max_bits)
                    pairs += got
                    open_key = me
                others = fp[s:e][probe[s:e]]
                if len(own) and len(others):
                    for at in range(0, len(others), 256):
                        part = others[at:at + 256]
                        i, j = np.nonzero(_near(int(seg[s]), part, own, max_bits))
                        if len(i):
                            pairs += map(tuple, np.unique(np.stack((root[j], part[i]), axis=1), axis=0).tolist())
            return pairs, rest

        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols[3] = cols[3].view(_U64)
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            if not len(cols[0]):
                continue
            pairs, carry = flush(cols, False)
            if pairs:
                yield made(pairs)
        if carry is not None:
            pairs, _ = flush(carry, True)
            if pairs:
                yield made(pairs)

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` of distinct fingerprints that span every component of
    the graph "at most ``max_bits`` (3) bits differ".  ``fps``: one column fp."""
    if max_bits != 3:
        raise ValueError("the chains' budgets are laid out for 3 bits over four segments")
    keyed = fps.select("fp").mapInArrow(_keys, _KEYED)
    spark, n = fps.sparkSession, tasks(fps.sparkSession)
    crowded = stored(keyed.filter("NOT probe").groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > block).select("seg", "key", F.ceil(F.col("n") / block).cast("int").alias("cells")),
                     "simhash-crowded")
    if crowded.isEmpty():
        placed = keyed.withColumn("cell", F.lit(0).cast("long"))
    else:
        # one's own block b meets each block in the cell (lower, higher); a probe visits the cells (b, b)
        b = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
        every = F.sequence(F.lit(0), F.col("cells") - 1)
        one = F.lit(1 << 20).cast("long")
        mine = F.transform(every, lambda o: F.least(o, b).cast("long") * one + F.greatest(o, b))
        theirs = F.transform(every, lambda o: o.cast("long") * one + o)
        cells = F.when(F.col("cells").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("probe"), theirs).otherwise(mine)
        placed = keyed.join(crowded, ["seg", "key"], "left").select("seg", "key", "fp", "probe", F.explode(cells).alias("cell"))
    placed = (placed.select("seg", "key", "cell", "fp", "probe").repartition(n, "seg", "key", "cell")
              .sortWithinPartitions("seg", "key", "cell", "probe"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    return placed.mapInArrow(_links(max_bits), "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(fp, root)`` for every node of ``links``: alternating large and small
    stars, each round written to the shared folder.  Only links travel, a node's
    smallest neighbour is a partial aggregate, and a star's hub is split by the
    adaptive skew join."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            arcs = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            arcs = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = arcs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        met = arcs.join(low, "u")
        if large:
            out = met.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("low").alias("b")).union(low.select(F.col("u").alias("a"), F.col("low").alias("b")))
        return out.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stored(links.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = stored(star(stored(star(edges, True), "large-star"), False), "small-star")
        now = state(edges)
        if tuple(now) == tuple(before):
            break
        before = now
    roots = edges.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("fp"), "root")
    return roots.union(roots.select(F.col("root").alias("fp"), "root").distinct())


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, block: int = BLOCK, row_key: Column | None = None) -> DataFrame:
    """``(id, key, fp, root, component_id)`` for each row of ``docs``; rows with one
    ``root`` (a fingerprint) are one group.  See the module's notes."""
    rows = stored(fingerprints(docs, text, shingle, id_col, row_key), "simhash")
    first = stored(rows.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    roots = stored(components(near_links(first, max_bits, block)), "simhash-roots")
    member = stored(first.join(roots, "fp", "left").select("fp", "id", F.coalesce("root", "fp").alias("root")), "simhash-member")
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    groups = stored(member.join(least, "root").select("fp", "root", "component_id"), "simhash-groups")
    return rows.join(groups, "fp")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null ids
    last), then of the smallest hash of the text; of repeated rows one stays."""
    key = F.md5(F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text)))
    found = near_duplicates(docs, text, id_col, row_key=key, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("row"))
    chosen = stored(first.select(F.col("row.key").alias("_row_key")), "simhash-kept")
    return (docs.withColumn("_row_key", key).join(chosen, "_row_key", "left_semi")
            .dropDuplicates(["_row_key"]).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_simhash(docs: DataFrame) -> DataFrame:
    """The digest of the operator: doc_id, fingerprint in 16 hex digits, component_id."""
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
