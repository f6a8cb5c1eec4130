"""Repeated passages, found by super-k-mers (operator 5).

A window is ``k`` (50) consecutive words of one document.  A word goes if a
window that covers it also starts in a document with a smaller id.  Windows are
judged on the input.

Consecutive windows that share a minimiser (the smallest hash of the ``m``-word
sequences inside them) travel as one packed string, a super-k-mer, to the
minimiser's bucket.  There sorting puts equal windows side by side.

1. Minimisers of every window, as runs, without text.  Only runs whose
   minimiser occurs in two or more documents go on: equal windows have equal
   minimisers.
2. Their packed strings.  Equal strings are reduced to the smallest id before
   and after the shuffle, so a group of copies arrives once.
3. In each bucket the windows of the different strings are sorted; the first of
   equal ones has the owner, the smallest id.  A bucket of over ``crowd``
   different strings (many contexts of one passage) goes no task whole: its
   strings are sorted over many tasks by the words right of the minimiser, then
   left of it, equal ones by the string's hash, so that one context of a third
   of all strings is cut apart too.  In such an order a neighbour shares the
   most words, so windows that reach further have no equal; they are cut off.
   What is left of the strings is mostly equal and again reduced to the smallest
   id.  A bucket that is still crowded is dealt out by whole window, with a
   partial minimum.
4. Owners go back to every run by the string's SHA-256, covered words to their
   document.

Edge cases: null and empty texts have no words; a text shorter than a window
loses nothing; repeated rows of one id keep their words (the id is not
smaller) and each gives a row, at a cost that grows with their number; a null id
counts as larger than all others; very long texts are handled in pieces of
bounded size; an empty table gives no rows.  Words are compared as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tillstack.llm.common import (byte_values, laid_out, same, small_batches, stored, tasks, text_key,
                                  word_chunks)

WINDOW, MINIMISER = 50, 8
#: Longest run of windows in one packed string, and most different strings sorted in one bucket.
RUN, CROWD = 256, 512
_U64 = np.uint64
_LAST = (1 << 63) - 1  # a null id's place in the order


def _word_hashes(data: bytes) -> np.ndarray:
    h64 = xxhash.xxh64_intdigest
    parts = [np.fromiter(map(h64, words), _U64, len(words)) for words in word_chunks(data) if words]
    return np.concatenate(parts) if parts else np.empty(0, _U64)


def _sequence_hashes(h: np.ndarray, m: int) -> np.ndarray:
    """The hash of every ``m`` (a power of two) consecutive words, given the words' hashes."""
    base, width = 0x9E3779B97F4A7C15, 1
    while width < m:
        h, base, width = h[:-width] * _U64(base) + h[width:], base * base % (1 << 64), 2 * width
    h = (h ^ (h >> _U64(29))) * _U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U64(32))


def window_minimisers(data: bytes, k: int = WINDOW, m: int = MINIMISER) -> tuple[np.ndarray, np.ndarray]:
    """Each window's bucket, and whether a run must end before the window.

    The bucket is the smallest hash of ``m`` consecutive words.  A window in which
    that hash occurs more than once (a repetitive text) has a bucket of its own
    kind, so that elsewhere all windows of a run share one place of the hash.
    """
    h = _word_hashes(data)
    if len(h) < k:
        return np.empty(0, _U64), np.empty(0, bool)
    h = _sequence_hashes(h, m)

    def joined(a, b):
        low = np.minimum(a[0], b[0])
        return low, np.where(a[0] == low, a[1], 0).astype(np.uint8) + np.where(b[0] == low, b[1], 0).astype(np.uint8)

    room, windows = k - m + 1, len(h) - (k - m)
    parts, width = [(h, np.ones(len(h), np.uint8))], 1  # smallest hash and its number, over 1, 2, 4... places
    while 2 * width <= room:
        low, n = parts[-1]
        parts.append(joined((low[:-width], n[:-width]), (low[width:], n[width:])))
        width *= 2
    found, at = None, 0
    for bit in range(len(parts) - 1, -1, -1):
        if room >> bit & 1:
            part = tuple(x[at:at + windows] for x in parts[bit])
            found, at = part if found is None else joined(found, part), at + (1 << bit)
    mini, n = found
    moved = np.concatenate(([False], (h[:windows - 1] == mini[:-1]) & (n[:-1] == 1)))  # the place falls out of the window
    return np.where(n == 1, mini, ~mini), moved


def _runs(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, starts, sizes, minis = [], [], [], []
            for r, data in enumerate(byte_values(b.column(2))):
                mini, moved = window_minimisers(data, k, m)
                if not len(mini):
                    continue
                cut = np.concatenate(([0], np.flatnonzero((mini[1:] != mini[:-1]) | moved[1:]) + 1, [len(mini)]))
                if (np.diff(cut) > RUN).any():  # a repetitive text: bounded strings
                    cut = np.unique(np.concatenate((cut, *(np.arange(a, z, RUN) for a, z in zip(cut, cut[1:])))))
                rows.append(np.full(len(cut) - 1, r))
                starts.append(cut[:-1])
                sizes.append(np.diff(cut))
                minis.append(mini[cut[:-1]])
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(minis).view(np.int64)), b.column(0).take(at), b.column(1).take(at),
                     pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32))],
                    ["mini", "id", "key", "start", "n"])
    return run


def _packed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, starts, minis, packs, size = [], [], [], [], 0
            spans = b.column(3).to_pylist()

            def made() -> pa.RecordBatch:
                at = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(minis, pa.int64()), b.column(0).take(at), b.column(1).take(at),
                     pa.array(starts, pa.int32()), pa.array(packs, pa.binary())], ["mini", "id", "key", "start", "pack"])

            for r, data in enumerate(byte_values(b.column(2))):
                text, begin, end = laid_out(data)
                for s in spans[r]:
                    packs.append(text[begin[s["start"]]:end[s["start"] + s["n"] + k - 2]])
                    rows.append(r)
                    starts.append(s["start"])
                    minis.append(s["mini"])
                    size += len(packs[-1])
                    if size > 1 << 24:
                        yield made()
                        rows, starts, minis, packs, size = [], [], [], [], 0
            if rows:
                yield made()
    return run


def _windows(pack: bytes, k: int) -> list[bytes]:
    ends = [i for i, c in enumerate(pack) if c == 32] + [len(pack)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    return [pack[starts[i]:ends[i + k - 1]] for i in range(len(ends) - k + 1)]


_OWNERS = StructType([StructField("mini", LongType()), StructField("sid", BinaryType()),
                      StructField("at", ArrayType(IntegerType())), StructField("own", ArrayType(LongType()))])


def _owners(k: int):
    """Rows sorted by bucket -> each string's windows that one of its documents doesn't own, with their owners."""

    def bucket(strings: list[tuple[int, bytes, int, int]]) -> list[tuple[int, bytes, list[int], list[int]]]:
        if len(strings) == 1 and strings[0][2] == strings[0][3]:
            return []
        at, own = [[] for _ in strings], [[] for _ in strings]
        last, first = None, 0
        for w, lo, s, i in sorted((w, x[2], s, i) for s, x in enumerate(strings) for i, w in enumerate(_windows(x[1], k))):
            if w != last:
                last, first = w, lo
            if first < strings[s][3]:
                at[s].append(i)
                own[s].append(first)
        return [(x[0], hashlib.sha256(x[1]).digest(), at[s], own[s]) for s, x in enumerate(strings) if at[s]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int, int]] = []
        out: list[tuple[int, bytes, list[int], list[int]]] = []

        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], _OWNERS.names)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[-1][0] != row[0]:
                    out += bucket(held)
                    held = []
                held.append(row)
                if len(out) >= 5000:
                    yield made()
                    out = []
        if held:
            out += bucket(held)
        if out:
            yield made()
    return run


def _anchored(m: int):
    """What stands left of a string's minimiser (last word first) and right of it.
    Strings of a repetitive bucket have no such place (``once`` is false)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right, once = [], [], []
            for mini, pack in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = pack.split(b" ")
                places = np.flatnonzero(_sequence_hashes(_word_hashes(pack), m).view(np.int64) == mini).tolist()
                once.append(len(places) == 1)
                at = places[0] if once[-1] else 0
                # a space after each word: sequences that share words are neighbours in byte order
                left.append(b"".join(w + b" " for w in words[:at][::-1]))
                right.append(b"".join(w + b" " for w in words[at + m:]) if once[-1] else b"")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                                              pa.array(once, pa.bool_())], [*b.schema.names, "left", "right", "once"])
    return run


def _common(a: bytes, b: bytes) -> int:
    """How many words two sequences, a space after each word, share from their start."""
    n = 0
    for x, y in zip(a.split(b" "), b.split(b" ")):
        if x != y or not x:
            break
        n += 1
    return n


def _shared(side: int):
    """Rows sorted by bucket and a side's words -> the most words that any other row
    of the bucket shares on that side: that of a neighbour.  A neighbour in
    another task may share everything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, bytes] | None = None
        held: list[tuple[pa.RecordBatch, int, int]] = []  # a row whose next one has not come yet, with its share so far
        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(b.column(0).to_pylist(), b.column(side).to_pylist()))
            meet = [_common(x[1], y[1]) if x[0] == y[0] else 0 for x, y in zip([before or keys[0], *keys], keys)]
            if before is None:
                meet[0] = 1 << 20
            if held:
                row, _, share = held.pop()
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([max(share, meet[0])], pa.int32())], [*b.schema.names, "most"])
            most = [max(x, y) for x, y in zip(meet, meet[1:])]
            if most:
                yield pa.RecordBatch.from_arrays([*b.slice(0, len(most)).columns, pa.array(most, pa.int32())], [*b.schema.names, "most"])
            held, before = [(b.slice(b.num_rows - 1), 0, meet[-1])], keys[-1]
        for row, _, _ in held:
            yield pa.RecordBatch.from_arrays([*row.columns, pa.array([1 << 20], pa.int32())], [*row.schema.names, "most"])
    return run


def _trimmed(k: int, m: int):
    """What is left of each string when windows that no other string can have are cut off both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for mini, pack, lo, hi, left, right, once, to_right, to_left in zip(*(c.to_pylist() for c in b.columns)):
                words, first, last = pack.split(b" "), 0, pack.count(b" ") + 1 - k  # windows first..last stay
                if once and lo == hi:
                    place = left.count(b" ")
                    first = max(first, place - to_left)
                    last = min(last, place + m + to_right - k)
                if first <= last:
                    out.append((mini, hashlib.sha256(pack).digest(), first, b" ".join(words[first:last + k]), lo, hi))
            if out:
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["mini", "whole", "shift", "pack", "lo", "hi"])
    return run


def _single_windows(k: int):
    """The different windows of a crowded bucket's strings, each for itself, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for mini, pack, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
                places: dict[bytes, list[int]] = {}
                for i, w in enumerate(_windows(pack, k)):
                    places.setdefault(w, []).append(i)
                sid = hashlib.sha256(pack).digest()
                out += [(mini, sid, at, hashlib.sha256(w).digest(), lo, hi) for w, at in places.items()]
            if out:
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["mini", "sid", "at", "w", "lo", "hi"])
    return run


def _cut_out(k: int, respace: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            covered = b.column(3).to_pylist()
            for r, data in enumerate(byte_values(b.column(2))):
                text, begin, end = laid_out(data)
                n = len(begin)
                total.append(n)
                if not covered[r]:
                    gone.append(0)
                    kept.append(text if respace else data)
                    continue
                edge = np.zeros(n + 1, np.int64)
                starts = np.unique(np.asarray(covered[r], np.int64))
                edge[starts] += 1
                edge[starts + k] -= 1
                stay = np.concatenate(([False], np.cumsum(edge[:-1]) == 0, [False]))
                turn = np.flatnonzero(stay[1:] != stay[:-1])
                kept.append(b" ".join(text[begin[a]:end[z - 1]] for a, z in zip(turn[::2], turn[1::2])))
                gone.append(int(n - stay.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *b.columns[4:], pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "key", *b.schema.names[4:], "n_words", "n_removed", "kept"])
    return run


def cut_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = WINDOW, m: int = MINIMISER,
                crowd: int = CROWD, carry: tuple[str, ...] = (), respace: bool = True) -> DataFrame:
    """``(id, key, *carry, n_words, n_removed, kept)`` for each row.

    ``kept`` is the text of the words that stay, joined by one space (without
    ``respace``, texts that lose nothing stay as they are); ``key`` is the hash of
    the row's text by which results meet their rows; ``carry`` names columns of
    ``docs`` to pass on as ``_c0``, ``_c1``...
    """
    spark = docs.sparkSession
    small_batches(spark)
    n, kind = tasks(spark), docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    ident = [StructField("id", kind), StructField("key", LongType())]
    order = F.coalesce(F.col("id").cast("long"), F.lit(_LAST))

    runs = stored(rows.mapInArrow(_runs(k, m), StructType(
        [StructField("mini", LongType()), *ident, StructField("start", IntegerType()), StructField("n", IntegerType())])), "windows")
    shared = (runs.groupBy("mini").agg(F.min(order).alias("lo"), F.max(order).alias("hi")).filter("lo < hi").select("mini"))
    spans = (runs.join(stored(shared, "minimisers"), "mini")
             .groupBy("id", "key").agg(F.collect_set(F.struct("start", "n", "mini")).alias("spans"))
             .select(F.col("id").alias("sid"), F.col("key").alias("skey"), "spans"))
    here = same(F.col("id"), F.col("sid")) & (F.col("key") == F.col("skey"))
    packs = stored(rows.join(stored(spans, "spans"), here).select("id", "key", "text", "spans").mapInArrow(_packed(k), StructType(
        [StructField("mini", LongType()), *ident, StructField("start", IntegerType()), StructField("pack", BinaryType())])), "super-k-mers")

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")  # packed strings are of bounded length
    strings = stored(packs.groupBy("mini", "pack").agg(F.min(order).alias("lo"), F.max(order).alias("hi")), "strings")
    columns = ["mini", "pack", "lo", "hi"]

    def parted(some: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The strings of crowded buckets and the others."""
        many = stored(some.groupBy("mini").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("mini"), "crowded")
        return some.select(columns).join(many, "mini", "left_semi"), some.select(columns).join(many, "mini", "left_anti")

    def sorted_owners(some: DataFrame) -> DataFrame:
        return some.select(columns).repartition(n, "mini").sortWithinPartitions("mini").mapInArrow(_owners(k), _OWNERS)

    many, few = parted(strings)
    owners = sorted_owners(few)
    # crowded buckets: cut off what only one string has, so that what they share becomes equal strings
    sides = StructType([*strings.select(columns).schema.fields, StructField("left", BinaryType()), StructField("right", BinaryType()),
                        StructField("once", BooleanType())])
    for side, at in (("right", 5), ("left", 4)):
        many = many.mapInArrow(_anchored(m), sides) if side == "right" else many
        schema = StructType([*many.schema.fields, StructField("most", IntegerType())])
        many = (many.repartitionByRange(n, "mini", side, F.xxhash64("pack")).sortWithinPartitions("mini", side).mapInArrow(_shared(at), schema)
                .withColumnRenamed("most", f"to_{side}"))
    cut = stored(many.mapInArrow(_trimmed(k, m), "mini long, whole binary, shift int, pack binary, lo long, hi long").distinct(), "trimmed")
    again, fewer = parted(stored(cut.groupBy("mini", "pack").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "shared-strings"))
    # what is crowded still has many different shared contexts: each window for itself
    single = stored(again.mapInArrow(_single_windows(k), StructType(
        [*_OWNERS.fields[:3], StructField("w", BinaryType()), StructField("lo", LongType()), StructField("hi", LongType())])), "single-windows")
    first = stored(single.groupBy("w").agg(F.min("lo").alias("own"), F.max("hi").alias("top")).filter("own < top").select("w", "own"), "first-windows")
    dealt = (single.join(first, "w").groupBy("mini", "sid").agg(F.collect_list(F.struct("at", "own")).alias("got"))
             .select("mini", "sid", F.flatten("got.at").alias("at"),
                     F.flatten(F.transform("got", lambda g: F.array_repeat(g.own, F.size(g["at"])))).alias("own")))
    shared = stored(sorted_owners(fewer).unionByName(dealt), "shared-owners")
    back = (cut.select("mini", "whole", "shift", F.unhex(F.sha2("pack", 256)).alias("sid")).join(shared, ["mini", "sid"])
            .select("mini", F.col("whole").alias("sid"), F.expr("transform(at, x -> x + shift)").alias("at"), "own"))
    owners = stored(owners.unionByName(back), "owners")

    packs = packs.withColumn("sid", F.unhex(F.sha2("pack", 256))).select("mini", "sid", "id", "key", "start")
    starts = F.expr(f"transform(filter(arrays_zip(at, own), x -> x.own < coalesce(cast(id as long), {_LAST})), x -> start + x.at)")
    covered = (packs.join(owners, ["mini", "sid"]).select("id", "key", starts.alias("starts")).filter(F.size("starts") > 0)
               .groupBy("id", "key").agg(F.flatten(F.collect_set("starts")).alias("starts"))
               .select(F.col("id").alias("sid"), F.col("key").alias("skey"), "starts"))
    covered = stored(covered, "covered")
    small_batches(spark)
    more = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)]
    whole = docs.select(F.col(id_col).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"), *more)
    return whole.join(covered, here, "left").select("id", "key", "text", "starts", *whole.columns[3:]).mapInArrow(_cut_out(k, respace), StructType(
        [*ident, *whole.schema.fields[3:], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]))


def op5_substring(docs: DataFrame) -> DataFrame:
    """The digest of the operator: doc_id, n_words, n_removed, kept_sha256."""
    return cut_repeats(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
