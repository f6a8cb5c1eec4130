"""Periodic runs in word sequences (operator 13).

A run is a maximal stretch of words with smallest period q and a length of at
least ``max(min_length, min_exponent * q)``.  Runs are found on an enhanced
suffix array (suffix order, its inverse, LCP values) of a batch of documents:

- suffixes are sorted by prefix doubling, only groups not yet apart are sorted
  on; words are numbered for each document, so no group holds two documents;
- the classes of every doubling are kept: two places with one class of level k
  agree in their next 2^k words, which gives LCP values and the backward
  extension by binary steps;
- LCP intervals come from one pass with a stack, no tree is built.  For every
  interval of depth d, the suffixes i outside its largest child are tested: if
  i + d (by the inverse order) lies in the interval but in another child, the
  square of period d at i branches, and so does the one at i - d if that does;
- a branching square is rotated to the left as far as words d apart agree; that
  is the run, as the square is the last one of its stretch.  Stretches that come
  again with a multiple of the period are merged into the smallest one.

Skipped without a loss: a run of four periods and six words repeats four words
inside its document, so documents without such a repeat have none; its interval
holds four suffixes at least, and four periods fit into the document.

Texts stay whole; a task holds the words of one Arrow batch and, for a group of
documents of about ``GROUP`` words (or one longer document), some 8 bytes a word
for each doubling.  Edge cases: null, empty and blank texts have no words, no
run and an empty collapsed text; a null id stays null and its text unedited;
repeated rows each give a row; an empty table gives no rows; other columns of
the table play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tillstack.llm.common import byte_values, small_batches, word_chunks

MIN_LENGTH, MIN_EXPONENT = 6, 4
GROUP = 1 << 17

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


class SuffixOrder:
    """Suffix order and prefix classes of several sequences laid end to end.

    ``code``: numbers of the words, different for different sequences; ``first``
    and ``end``: where the sequence of each place starts and ends.
    """

    def __init__(self, code: np.ndarray, first: np.ndarray, end: np.ndarray, most: int | None = None):
        n = len(code)
        self.first, self.end, self.levels = first, end, []
        order = np.argsort(code, kind="stable")
        head = np.ones(n, bool)
        head[1:] = code[order[1:]] != code[order[:-1]]
        rank = np.full(n + 1, -1, np.int32)  # the slot of its group's first suffix; a last place that equals nothing
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        width = 1
        while True:
            self.levels.append(rank.copy())
            alone = head.copy()
            alone[:-1] &= head[1:]
            slots = np.flatnonzero(~alone)
            if not len(slots) or (most is not None and width >= most):
                break
            place = order[slots]
            after = place + width
            second = np.where(after < end[place], rank[np.minimum(after, n)], -1)
            key = rank[place].astype(np.int64) * (n + 1) + second + 1
            by = np.argsort(key, kind="stable")
            place, key = place[by], key[by]
            order[slots] = place
            new = np.ones(len(slots), bool)
            new[1:] = key[1:] != key[:-1]
            head[slots] = new
            rank[place] = np.maximum.accumulate(np.where(new, slots, 0))
            width *= 2
        self.order, self.undecided = order, slots
        self.inverse = np.empty(n, np.int64)
        self.inverse[order] = np.arange(n)

    def lcp(self) -> np.ndarray:
        """How many words the suffixes of two neighbouring slots share (slot 0: none)."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        out = np.zeros(len(self.order), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][a] == self.levels[k][b]
            step = same.astype(np.int64) << k
            out[1:] += step
            a += step
            b += step
        return out

    def before(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words before ``at`` (the earlier) and ``other`` agree."""
        at, other, first = at.copy(), other.copy(), self.first[at]
        out = np.zeros(len(at), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            back = at - (1 << k)
            same = (back >= first) & (self.levels[k][np.maximum(back, 0)] == self.levels[k][np.maximum(other - (1 << k), 0)])
            step = same.astype(np.int64) << k
            out += step
            at -= step
            other -= step
        return out


def _small_children(lcp: np.ndarray, fewest: int) -> np.ndarray:
    """For every LCP interval of ``fewest`` suffixes or more, a row ``(depth, low,
    high, child's low, child's high)`` of slots for each child but the largest."""
    out: list[tuple] = []
    stack: list[tuple] = []
    for p, d in enumerate([*lcp.tolist(), 0]):
        low = p - 1
        while stack and stack[-1][0] > d:
            depth, low, cuts = stack.pop()
            if p - low >= fewest:
                bounds = [low, *cuts, p]
                sizes = [b - a for a, b in zip(bounds, bounds[1:])]
                big = sizes.index(max(sizes))
                out += [(depth, low, p, bounds[c], bounds[c + 1]) for c in range(len(sizes)) if c != big]
        if d > 0:
            if stack and stack[-1][0] == d:
                stack[-1][2].append(p)
            else:
                stack.append((d, low, [p]))
    return np.array(out, np.int64).reshape(-1, 5)


def _branching(sa: SuffixOrder, rows: np.ndarray) -> np.ndarray:
    """The branching squares ``(start, period)`` among the children's suffixes."""
    n, found = len(sa.order), []
    sizes = rows[:, 4] - rows[:, 3]
    upto = np.cumsum(sizes)
    cut = 0
    while cut < len(rows):  # bounded pieces of the n log n suffixes
        done = upto[cut - 1] if cut else 0
        last = max(cut + 1, int(np.searchsorted(upto, done + (1 << 20), side="right")))
        part, size = rows[cut:last], sizes[cut:last]
        of = np.repeat(np.arange(len(part)), size)
        slot = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + part[of, 3]
        i, d = sa.order[slot], part[of, 0]
        for j, start in ((i + d, i), (i - d, i - d)):
            inside = (j >= 0) & (j < n)
            at = sa.inverse[np.where(inside, j, 0)]
            hit = inside & (at >= part[of, 1]) & (at < part[of, 2]) & ((at < part[of, 3]) | (at >= part[of, 4]))
            found.append(np.stack((start[hit], d[hit]), axis=1))
        cut = last
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


def find_runs(codes: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """The runs of every sequence of numbers: rows ``(start, length, period)`` by start, then period."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run holds a square: an exponent and a length of two at least")
    out = [np.empty((0, 3), np.int64) for _ in codes]
    repeat = max(min_length - min_length // min_exponent, min_exponent - 1, 1)  # words that a run shares with itself, at least
    width = 1 << (repeat.bit_length() - 1)
    asked = np.arange(len(codes))
    for most in (width, None):
        asked = asked[[len(codes[i]) >= min_length for i in asked]]
        if not len(asked):
            return out
        sizes = np.array([len(codes[i]) for i in asked])
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        of = np.repeat(np.arange(len(asked)), sizes)
        raw = np.concatenate([codes[i] for i in asked]).astype(np.int64)
        sa = SuffixOrder(of * (int(raw.max()) + 1) + raw, first, first + np.repeat(sizes, sizes), most)
        if most is not None:
            asked = asked[np.unique(of[sa.order[sa.undecided]])]  # those that repeat ``width`` words
    rows = _small_children(sa.lcp(), min_exponent)
    if len(rows):
        rows = rows[rows[:, 0] * min_exponent <= sizes[of[sa.order[rows[:, 1]]]]]
    squares = _branching(sa, rows)
    if not len(squares):
        return out
    start, period = squares[:, 0], squares[:, 1]
    begin = start - sa.before(start, start + period)
    length = start + 2 * period - begin
    keep = length >= np.maximum(min_length, min_exponent * period)
    begin, length, period = begin[keep], length[keep], period[keep]
    by = np.lexsort((period, length, begin))
    begin, length, period = begin[by], length[by], period[by]
    new = np.ones(len(begin), bool)  # of equal stretches the smallest period
    new[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, period = begin[new], length[new], period[new]
    by = np.lexsort((period, begin))
    table = np.stack((begin, length, period), axis=1)[by]
    owner = of[table[:, 0]]
    table[:, 0] -= first[table[:, 0]]
    for k in np.unique(owner).tolist():
        out[asked[k]] = table[owner == k]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside all runs and those of each run's first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    turn = np.zeros(len(words) + 1, np.int64)
    np.add.at(turn, runs[:, 0] + runs[:, 2], 1)
    np.add.at(turn, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(turn)[:-1] == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def planted(words: list[bytes], ident) -> list[bytes]:
    """The contract's edit: every tenth document by crc32 of its id repeats from a place on."""
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a:a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[:n - a]


def periodic_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, edit: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for each row: the runs by start, then
    period, and the text (UTF-8) without their repeats.  ``edit(words, id)`` may
    change a row's words first."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = StructType([StructField("id", kind), StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)),
                         StructField("collapsed", BinaryType())])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, count = [], 0

            def made() -> pa.RecordBatch:
                coded = pa.array([w for _, words in held for w in words], pa.binary()).dictionary_encode()
                code = coded.indices.to_numpy(zero_copy_only=False)
                cuts = np.cumsum([len(words) for _, words in held])[:-1]
                found = find_runs(np.split(code, cuts), min_length, min_exponent)
                flat = np.concatenate(found)
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in found])))
                runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, c], pa.int64()) for c in range(3)], fields=list(types[2].value_type)))
                return pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in held], types[0]), pa.array([len(words) for _, words in held], types[1]), runs.cast(types[2]),
                     pa.array([collapse(words, r) for (_, words), r in zip(held, found)], types[3])], schema.names)

            for ident, data in zip(b.column(0).to_pylist(), byte_values(b.column(1))):
                words = [w for some in word_chunks(data) for w in some]
                words = edit(words, ident) if edit else words
                held.append((ident, words))
                count += len(words)
                if count >= GROUP:
                    yield made()
                    held, count = [], 0
            if held:
                yield made()

    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def op13_runs(docs: DataFrame) -> DataFrame:
    """The digest of the operator on texts edited by ``planted``."""
    found = periodic_runs(docs, edit=planted)
    none = F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)")
    # by start, then period: a later run is taken only if its exponent is greater
    best = F.aggregate("runs", none, lambda a, r: F.when(a.isNull() | (r.length * a.period > a.length * r.period), r).otherwise(a))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")),
                                                  F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
