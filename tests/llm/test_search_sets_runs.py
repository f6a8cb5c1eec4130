"""Operators 11 to 13 against brute force, with every awkward row."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tillstack.llm import lexical, minhash, runs

WORDS = [f"w{i}" for i in range(400)]


def texts():
    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(120)]
    out = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "ONE  two"), (8, "one"),
           (None, " ".join(base)), (9, "the " * 40), (10, "the " * 30), (11, "naïve 漢字 — É é it's w1 w2"), (11, "other text, id of eleven")]
    for i in range(12, 60):  # near copies of each other at many distances
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(120)] = rng.choice(WORDS)
        out.append((i, " ".join(copy)))
    out += [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 200)))) for i in range(60, 90)]
    out += [(90, "a b c " * 9 + "x y"), (91, "a " * 7), (92, "p q p q p q p q p"), (93, "w " + "L" * 300000 + " w w w w w w"), (8, "one"), (8, "one")]
    return out


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that the operators use inside."""
    rows = [(i, t, "x", 1, "y", 2, 3) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, id long, key string, n int, rank int").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_sets():
    sets = []
    for _, t in ROWS:
        w = split(lowered(t))
        sets.append({" ".join(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {" ".join(w)} if w else set())
    group = list(range(len(ROWS)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    ids = {}
    for r, (i, _) in enumerate(ROWS):
        if i is not None:
            ids.setdefault(find(r), []).append(i)
    return sorted(((i, len(sets[r]), i if not sets[r] else min(ids.get(find(r), [None]))) for r, (i, _) in enumerate(ROWS)), key=repr)


@pytest.mark.parametrize("block, group_bytes", [(4096, 16 << 20), (3, 4000)])
def test_minhash(docs, block, group_bytes):
    got = sorted((tuple(r) for r in minhash.near_duplicates(docs, block=block, group_bytes=group_bytes).collect()), key=repr)
    assert got == brute_sets()


def test_minhash_digest_and_empty_table(docs, none):
    rows = minhash.op12_minhash(docs).collect()
    assert len(rows) == len(ROWS) and all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert minhash.op12_minhash(none).collect() == []


def test_grouped_batches_keep_groups_whole():
    import pyarrow as pa
    keys = [1, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    for size in (1, 2, 3, 4, 20):
        parts = [keys[i:i + size] for i in range(0, len(keys), size)]
        seen = []
        for t, cut in minhash._grouped(iter([pa.RecordBatch.from_arrays([pa.array(p, pa.int64())], ["k"]) for p in parts]), 1):
            c = t.column(0).to_pylist()
            seen += [c[s:e] for s, e in zip(cut[:-1], cut[1:])]
        assert seen == [[1, 1], [2] * 5, [3], [4, 4]], size


def test_sketch_finds_links_at_the_threshold():
    """Sets at a similarity of 0.85 share a band and pass the signature."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        both, own = rng.integers(0, 1 << 63, 85, np.uint64), rng.integers(0, 1 << 63, 15, np.uint64)
        a, b = (np.frombuffer(minhash.sketch(np.sort(x)), np.uint8) for x in (np.concatenate((both, own)), both))
        ka, kb = a[:256].view("<u8"), b[:256].view("<u8")
        assert (ka == kb).any() and (a[256:] == b[256:]).sum() >= minhash.LEAST_EQUAL


ITEMS = [(0, "w1 w2 w3 w3 W4"), (1, None), (2, "nothing-of-this zzz"), (3, "the one naïve é"), (4, " ".join(WORDS[:50])), (4, "w7"), (None, "w9 w9 w10")]


def brute_ranks(k):
    found = [(i, [t for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(t))]) for i, t in ROWS]
    found = [(i, t) for i, t in found if t]
    n, total = len(found), sum(len(t) for _, t in found)
    out = []
    for item, text in ITEMS:
        rows = []
        for i, t in found:
            m = 100 - 25 + 25 * len(t) * n // total
            score = 0
            for q in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)):
                df, tf = sum(q in x for _, x in found), t.count(q)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if last else i, -s) for r, (s, last, i) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, shard, block", [(20, 8192, 128), (5, 16, 2), (3, 64, 1)])
def test_lexical(spark, docs, monkeypatch, k, shard, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in lexical.ranked(docs, items, k=k, shard=shard).collect()), key=repr)
    assert got == brute_ranks(k)


def test_lexical_by_small_item_groups_and_empty_tables(spark, docs, none, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_TERMS", 4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted((tuple(r) for r in lexical.ranked(docs, items).collect()), key=repr) == brute_ranks(20)
    assert lexical.op11_lexical(none, items).collect() == []
    assert lexical.op11_lexical(docs, items.limit(0)).collect() == []


def test_lexical_skips_blocks_by_bounds_alone():
    """A shard with one good cluster: few documents are evaluated, the best are right."""
    rng = np.random.default_rng(3)
    n, v = 4000, 40
    dense = (rng.random((n, v)) < 0.2) * rng.integers(1, 4, (n, v))
    dense[:30, :10] = 9
    of, term = np.nonzero(dense)
    m = np.full(n, 100)
    shard = lexical.Shard(np.arange(n), of, term, dense[of, term], m)
    w = np.array([9000] * 10 + [200] * 10)
    items = [(np.arange(20), w)]
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    shard.search(items, [np.arange(20)] * v, best, 20)
    full = (lexical.impact(dense, m[:, None])[:, :20] * w).sum(axis=1)
    want = sorted(range(n), key=lambda i: (-full[i], i))[:20]
    assert best[0][1].tolist() == want and best[0][0].tolist() == full[want].tolist()
    assert shard.evaluated < n // 2


def brute_runs(c, least, exponent):
    n, out, seen = len(c), [], set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if c[i] != c[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and c[i] == c[i + q]:
                i += 1
            size = i + q - s
            if size >= max(least, exponent * q) and (s, size) not in seen:
                seen.add((s, size))
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(400):
        seqs = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.randint(0, 60), rng.randint(1, 4)
            seq = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                seq = [seq[i if i < a else a + (i - a) % p] for i in range(n)]
            seqs.append(seq)
        exponent, least = rng.choice([4, 4, 2, 3]), rng.choice([6, 6, 2, 4, 9])
        got = runs.find_runs([np.array(s, np.int32) for s in seqs], least, exponent)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(s, least, exponent) for s in seqs]


def test_runs_digest(docs, none, spark):
    more = spark.createDataFrame([(i, " ".join(random.Random(i).choices(WORDS[:30], k=5 + i % 70))) for i in range(1000, 1150)],
                                 "doc_id long, text string")
    rows = [(i, t) for i, t in ROWS] + [(r.doc_id, r.text) for r in more.collect()]
    want = []
    for ident, text in rows:
        w = split(text)
        n, h = len(w), zlib.crc32(str(ident).encode()) if ident is not None else 1
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w, 6, 4)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        gone = {i for s, size, q in found for i in range(s + q, s + size)}
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{size},{q}\n" for s, size, q in found),
                                                                   " ".join(x for i, x in enumerate(w) if i not in gone))]
        want.append((ident, len(found), *best, 1000 * best[1] // best[2] if found else None, *digest))
    got = runs.op13_runs(docs.select("doc_id", "text").unionByName(more))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 10
    assert runs.op13_runs(none).collect() == [] and runs.op13_runs(docs).count() == len(ROWS)


def test_runs_of_long_texts():
    """Work stays in proportion: all words alike, and a Fibonacci word."""
    assert runs.find_runs([np.zeros(50000, int)])[0].tolist() == [[0, 50000, 1]]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert [tuple(r) for r in runs.find_runs([np.array(b)], 6, 3)[0].tolist()] == brute_runs(b, 6, 3)
