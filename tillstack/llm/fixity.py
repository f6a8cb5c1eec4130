"""Merkle fixity audit of WARC replicas (operator 1).

A file's records (offset, length, SHA-256 of the bytes) are the leaves.  Inner
nodes cover ranges of offsets: ``RANGE`` bytes first, then ``FANOUT`` times as
many at each level, at last the file.  A node's digest is the SHA-256 of its
children's digests in order of offset, so a node needs no neighbour and a tree
is a few group-bys; a leaf range holds at most ``RANGE`` / (size of a record)
different records.

The audit compares the replicas' roots and goes down only where digests differ:
at each level only children of differing nodes are joined.  What is left are the
damaged, missing and surplus records.

Edge cases: records that repeat (same file, offset, length and digest) enter a
node once, with their number; null payloads count as empty; a null file or
offset is a file or place of its own; files that only one replica has differ
from the root down; empty replicas give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillstack.llm.common import stored

RANGE, FANOUT, LEVELS = 1 << 16, 16, 4
#: Pages in one WARC file of the query, and the damage of its second replica.
FILE_PAGES, FLIP, LOSE = 500, (97, 13), (211, 5)


def leaves(records: DataFrame, file: str = "file", offset: str = "offset", payload: str = "payload") -> DataFrame:
    """``(file, offset, length, digest, n)`` of the records."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return _leaves(records.select(F.col(file).alias("file"), F.col(offset).cast("long").alias("offset"),
                                  F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest")))


def _leaves(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n"))


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.collect_list(parts)).getField("text"), "\n"), 256)


def tree(leaf: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """``(file, node, digest)`` of each level: offset ranges from the finest up, then
    the file as node 0."""
    width = RANGE
    text = F.concat_ws(":", F.coalesce(F.col("offset").cast("string"), F.lit("none")), "length", "digest", "n")
    out = [leaf.groupBy("file", F.floor(F.col("offset") / width).alias("node"))
           .agg(_digest(F.struct("offset", "length", "digest", text.alias("text"))).alias("digest"))]
    for level in range(1, levels + 1):
        above = F.floor(F.col("node") / FANOUT) if level < levels else F.lit(0).cast("long")
        text = F.concat_ws(":", F.coalesce(F.col("node").cast("string"), F.lit("none")), "digest")
        out.append(out[-1].groupBy("file", above.alias("up")).agg(_digest(F.struct("node", text.alias("text"))).alias("digest"))
                   .withColumnRenamed("up", "node"))
    return out


def _differ(a: DataFrame, b: DataFrame, on: list[str], digest: list[str]) -> DataFrame:
    """Keys of which the sides have different digests, or only one side has any."""
    left, right = (x.select(*[F.col(c).alias(f"{s}_{c}") for c in [*on, *digest]], F.lit(True).alias(f"{s}_here"))
                   for s, x in (("a", a), ("b", b)))
    met = left.join(right, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in on], "full_outer")
    same = F.coalesce(F.col("a_here") & F.col("b_here"), F.lit(False))
    for c in digest:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return met.filter(~same)


def audit(a: DataFrame, b: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Records in which the replicas' leaves ``a`` and ``b`` differ: ``(file, offset,
    a_length, a_digest, b_length, b_digest, status)``."""
    tree_a, tree_b = ([stored(x, "merkle") for x in tree(side, levels)] for side in (a, b))
    key = lambda c: F.coalesce(F.col(f"a_{c}"), F.col(f"b_{c}")).alias(c)
    bad = stored(_differ(tree_a[-1], tree_b[-1], ["file", "node"], ["digest"]).select(key("file"), key("node")), "differ")
    for level in range(levels - 1, -1, -1):
        up = F.floor(F.col("node") / FANOUT) if level < levels - 1 else F.lit(0).cast("long")
        below = [_under(t[level], up, bad) for t in (tree_a, tree_b)]
        bad = stored(_differ(*below, ["file", "node"], ["digest"]).select(key("file"), key("node")), "differ")
    below = [_under(x, F.floor(F.col("offset") / RANGE), bad) for x in (a, b)]
    found = _differ(*below, ["file", "offset"], ["length", "digest", "n"])
    status = F.when(F.col("b_here").isNull(), "missing").when(F.col("a_here").isNull(), "surplus").otherwise("damaged")
    return found.select(key("file"), key("offset"), "a_length", "a_digest", "b_length", "b_digest", status.alias("status"))


def _under(rows: DataFrame, up: Column, bad: DataFrame) -> DataFrame:
    """The rows whose parent is among the differing nodes."""
    picked = bad.select(F.col("file").alias("_file"), F.col("node").alias("_node"))
    kept = rows.withColumn("_up", up)
    return kept.join(picked, kept["file"].eqNullSafe(picked["_file"]) & kept["_up"].eqNullSafe(picked["_node"]), "left_semi").drop("_up")


def warc_leaves(pages: DataFrame, file_pages: int = FILE_PAGES, damaged: bool = False) -> DataFrame:
    """The leaves of WARC files made of ``pages`` in order of their id, ``file_pages``
    ids a file; ``damaged``: of a replica in which some records have another first
    sign and some are lost, each at its place.  Only sizes and digests are shuffled."""
    html = F.coalesce(F.col("html"), F.lit(""))
    body = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    hit = lambda rule: F.coalesce(F.col("page_id") % rule[0] == rule[1], F.lit(False))
    read = F.when(hit(FLIP), F.concat(F.lit("w"), F.substring(body, 2, (1 << 31) - 1))).otherwise(body) if damaged else body
    rows = pages.select(F.floor(F.col("page_id") / file_pages).alias("file"), "page_id", F.octet_length(body).cast("long").alias("length"),
                        F.sha2(read, 256).alias("digest"))
    before = W.partitionBy("file").orderBy("page_id", "digest").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    if damaged:
        rows = rows.filter(~hit(LOSE))
    return _leaves(rows)


def op1_fixity(pages: DataFrame) -> DataFrame:
    """Where a replica of the pages' WARC files, with damage by rule, differs."""
    return audit(stored(warc_leaves(pages), "leaves"), stored(warc_leaves(pages, damaged=True), "leaves")).select(
        F.col("file").alias("file_id"), "offset", F.col("a_length").alias("length"), F.col("a_digest").alias("sha256"),
        F.col("b_digest").alias("replica_sha256"), "status")


SQL = f"""
WITH r AS (
  SELECT page_id, page_id // {FILE_PAGES} AS file_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
    || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body FROM pages),
o AS (
  SELECT *, coalesce(sum(strlen(body)) OVER (PARTITION BY file_id ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM r)
SELECT file_id, CAST(place AS BIGINT) AS "offset", CAST(strlen(body) AS BIGINT) AS length, sha256(body) AS sha256,
  CASE WHEN page_id % {LOSE[0]} = {LOSE[1]} THEN NULL ELSE sha256('w' || substr(body, 2)) END AS replica_sha256,
  CASE WHEN page_id % {LOSE[0]} = {LOSE[1]} THEN 'missing' ELSE 'damaged' END AS status
FROM o WHERE page_id % {FLIP[0]} = {FLIP[1]} OR page_id % {LOSE[0]} = {LOSE[1]}
"""
