"""The operators on small tables with every awkward row, against brute force."""

import hashlib
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from tillstack.llm import bpe, fixity, licenses, packing, quality, simhash, substring, template, topk, winnow

PASSAGE = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, "Alpha beta gamma delta. " * 20), (2, "Alpha beta gamma delta. " * 20), (3, None), (4, ""), (5, " \n\t"),
        (6, "x1 " + PASSAGE + " tail one"), (7, "x2 " + PASSAGE + " tail two"), (7, "other text with the id of seven"),
        (8, "x2 " + PASSAGE + " tail two"), (8, "x2 " + PASSAGE + " tail two"), (None, "no id " + PASSAGE), (9, "the " * 120),
        (10, "the " * 90), (11, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."), (12, "naïve 漢字 　 it's 12"),
        (13, "L" * 9000 + " end"), (14, "short")]
SCHEMA = "doc_id long, text string, fp string, id long, n int"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "clash", 5, 6) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [4096, 1])
def test_simhash(docs, block):
    fps = [simhash.fingerprint((t or "").encode()) for _, t in ROWS]
    group = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    want = sorted(((i, f, min(x for (x, _), h in zip(ROWS, group) if h == g and x is not None) if any(
        x is not None for (x, _), h in zip(ROWS, group) if h == g) else None) for (i, _), f, g in zip(ROWS, fps, group)), key=repr)
    got = simhash.near_duplicates(docs, block=block)
    assert bag(got.selectExpr("id", "fp", "component_id"), "id", "fp", "component_id") == sorted(
        ((i, f - (1 << 64) if f >> 63 else f, c) for i, f, c in want), key=repr)


def test_links_of_many_near_fingerprints(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(1 << 62))
    fps = {base}
    for _ in range(300):
        fps.add(base ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(1, 7)))))
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 300)}
    order = sorted(fps)
    parent = {f: f for f in order}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[find(b)] = find(a)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    frame = spark.createDataFrame([(signed(f),) for f in order], "fp long")
    for block in (4096, 8):
        roots = {r.fp: r.root for r in simhash.components(simhash.near_links(frame, block=block)).collect()}
        got, want = {}, {}
        for f in order:
            got.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
            want.setdefault(find(f), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_of_each_group_stays(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(8) <= 1 and sum(i in ids for i in (3, 4, 5)) == 1
    assert simhash.keep_one(none).count() == 0 and simhash.op2_simhash(none).count() == 0


@pytest.mark.parametrize("crowd", [512, 1])
def test_substring(docs, crowd):
    first, want = {}, []
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0]))
    for i, t in order:
        words = (t or "").split()
        for j in range(len(words) - 49):
            first.setdefault(tuple(words[j:j + 50]), i)
    for i, t in order:
        words = (t or "").encode().split()
        gone = set()
        for j in range(len(words) - 49):
            owner = first[tuple((t or "").split()[j:j + 50])]
            if owner is not None and (i is None or owner < i):
                gone |= set(range(j, j + 50))
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((i, len(words), len(gone), kept.decode()))
    got = substring.cut_repeats(docs, crowd=crowd)
    assert bag(got, "id", "n_words", "n_removed", "kept") == sorted(want, key=repr)


def test_quality(spark, docs, none):
    good = [(i, "The cat sat on the mat and looked at the sea. " * (1 + i % 5)) for i in range(0, 400, 2)]
    junk = [(i, "BUY!! NOW!! | $$$ | ### | WIN!! " * (1 + i % 5)) for i in range(1, 400, 2)]
    table = spark.createDataFrame([*good, *junk, (None, "text"), (900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)] + [(5, None), (9999, 1)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality.op3_quality(table, labels).collect()}
    assert len(rows) == 402 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400)) and rows[None].held_out
    assert all(rows[i].predicted == int(i % 2 == 0) for i in range(400) if rows[i].held_out)
    assert {r.score for r in quality.op3_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.op3_quality(none, labels).count() == 0


def test_pair_identity():
    rng = np.random.default_rng(0)
    m = quality.FactorisationMachine(0.1, rng.normal(size=7), rng.normal(size=(7, 3)))
    x = rng.normal(size=(4, 7))
    z = [0.1 + r @ m.linear + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(7) for j in range(i)) for r in x]
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-np.array(z))))


def test_bpe(docs, none, monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in ROWS:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    assert bag(bpe.op7_bpe(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.op7_bpe(none).count() == 0
    coded = bpe.encode(docs, ranks)
    assert bag(bpe.decode(coded, ranks), "id", "decoded") == sorted(((i, (t or "").encode()) for i, t in ROWS), key=repr)


def test_bpe_blocks_are_not_shuffled(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plan = bpe.encode(docs, ranks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == plan.count("Exchange hashpartitioning(of_block") == 1


@pytest.mark.parametrize("parts, share", [(4096, 1 << 18), (2, 5)])
def test_bpe_gathers_words(docs, monkeypatch, parts, share):
    """Every place of every word without a rank, whatever the numbers of parts and shares."""
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    monkeypatch.setattr(bpe, "WORD_PLACES", parts)
    monkeypatch.setattr(bpe, "SHARE_PLACES", share)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    blocks = bpe.word_blocks(docs, ranks, "text", "doc_id").select("block", "load", "words").localCheckpoint()
    want = sorted((w, r.block, j) for r in blocks.collect() for j, w in enumerate(r.words))
    got = bpe.gather_words(blocks).collect()
    assert want and sorted((r.word, p.block, p.j) for r in got for p in r.places) == want
    assert parts < 4096 or len({r.word for r in got}) == len(got)


def test_packing(docs, none):
    rows = packing.op8_packing(docs).collect()
    path = packing.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    whole = [(i, np.append(path.ids(t or ""), np.uint32(0)).astype("<u4")) for i, t in ROWS]
    assert sum(r.length for r in rows) == sum(len(x) for _, x in whole)
    crcs = {(i, int(np.int64(a)), zlib.crc32(x[a:z].tobytes())) for i, x in whole for a, z in
            [(max(0, len(x) - 2048 * (k + 1)), len(x) - 2048 * k) for k in range(-(-len(x) // 2048))]}
    assert {(r.doc_id, r.start, r.ids_crc32) for r in rows} == crcs
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
        assert end <= 2048
    assert packing.op8_packing(none).count() == 0


def test_winnowing(docs, none):
    order = sorted(((t or "", i) for i, t in ROWS), key=lambda r: (r[1] is None, r[1], _signed(r[0])))
    want = []
    for n, (t, i) in enumerate(order):
        after, half = order[(n + 1) % len(order)][0], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c = (winnow.fingerprint(x) for x in (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), winnow.as_text(a), winnow.likeness(a, b), winnow.likeness(a, c)))
    got = bag(winnow.op10_winnowing(docs), "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    assert got == sorted(want, key=repr)
    assert winnow.op10_winnowing(none).count() == 0


def _signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_licenses(docs, none):
    rows = {r.doc_id: r for r in licenses.op9_licenses(docs).collect()}
    assert rows[11].licenses == "CC-BY-NC-4.0,MIT" and rows[11].n_units == 2 and rows[11].best_dice == 1.0
    assert rows[3].licenses == "" and rows[3].best_license is None
    plan = licenses.op9_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "").split("Scan")[0]
    assert licenses.op9_licenses(none).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(120)]
    vectors += [(7, vectors[7][1]), (None, [1.0] * 4), (200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [1.0, 2.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    whole = sorted({(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in vectors
                    if v and None not in v and len(v) == 4 and not np.isnan(v).any()}, key=repr)
    want = []
    for i, v in whole:
        if i is not None and i % 50 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in whole if j != i)[:5]
            want += [(i, n + 1, None if last else j, -s) for n, (s, last, j) in enumerate(ranked)]
    for block in (4096, 30):
        got = topk.top_k(table, topk.F.col("id") % 50 == 0, block=block, query_block=2)
        assert bag(got, "query_id", "rank", "id", "score") == sorted(want, key=repr)
    assert topk.op6_topk(table.limit(0)).count() == 0


def test_top_k_skips_cells(spark):
    """Two far groups of vectors: a query's candidates are dealt from its own group only."""
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 8)) * 40
    vectors = [(i, [float(x) for x in middles[i % 6] + rng.normal(size=8)]) for i in range(600)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = np.floor(256 * np.array([v for _, v in vectors]))
    want = []
    for i in range(0, 600, 50):
        scores = whole @ whole[i]
        scores[i] = -np.inf
        want += [(i, n + 1, int(j), int(scores[j])) for n, j in enumerate(np.lexsort((np.arange(600), -scores))[:5])]
    got = topk.top_k(table, topk.F.col("id") % 50 == 0, block=60, query_block=3)
    assert bag(got, "query_id", "rank", "id", "score") == sorted(want, key=repr)
    row = lambda cell, low, high, most: type("Row", (), dict(dim=8, cell=cell, n=1, low=low, high=high, most=most))
    cells = topk.Cells([row(0, [0.0, 90.0], [5.0, 99.0], 100.0), row(1, [90.0, 0.0], [99.0, 5.0], 100.0)])
    assert cells.reached(8, np.ones(8), np.array([2.0, 95.0]), 0.0) == [0] and cells.reached(8, np.ones(8), np.array([2.0, 95.0]), -1e9) == [0, 1]
    far = spark.createDataFrame([(0, [1e20] * 4), (1, [0.0] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 2\\^53"):
        topk.op6_topk(far).collect()


def test_pages(spark):
    page = "<html><body><nav>Menu</nav><article><h1>T</h1><p>Body &amp; {}</p></article><footer>same</footer></body></html>"
    rows = [(i, f"https://a.org/{i}", page.format(i)) for i in range(6)] + [(7, None, None), (8, "odd", ""), (9, "http://b.org", "<p>x"), (9, "http://b.org", "<p>x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = bag(template.op4_template(table), "page_id", "text", "n_chars")
    assert got == sorted([(i, f"T\n\nBody & {i}", 11) for i in range(6)] + [(7, "", 0), (8, "", 0), (9, "x", 1), (9, "x", 1)], key=repr)
    assert template.op4_template(table.limit(0)).count() == 0


def test_fixity(spark):
    good = [("f", 70_000 * i, f"record {i}") for i in range(50)] + [("g", 0, None), (None, 5, "x"), ("f", 0, "record 0")]
    bad = [r for r in good if r[1] != 70_000 * 7] + [("f", 999_999_999, "more")]
    bad = [(f, o, "rotten" if o == 70_000 * 3 else p) for f, o, p in bad]
    schema = "file string, offset long, payload string"
    a, b = (fixity.leaves(spark.createDataFrame(x, schema)) for x in (good, bad))
    assert bag(fixity.audit(a, b), "file", "offset", "status") == [("f", 210000, "damaged"), ("f", 490000, "missing"), ("f", 999999999, "surplus")]
    assert fixity.audit(a, a).count() == 0 and fixity.audit(a.limit(0), b.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_SMALL)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.toArrow(), docs.schema)
        assert after.count() <= before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_oracle(spark):
    from tests.conftest import SF_SMALL
    from tests.oracle_harness import compare, duck
    con = duck(SF_SMALL)
    for name in ("op1_fixity", "op6_topk", "op9_licenses"):
        assert compare(spark, name, SF_SMALL, con)["status"] == "ok", name


def test_template_blocks_inside_articles(spark):
    def page(i, near=""):
        box = '<div class="box-7"><p>Get our letter</p><p>Every week</p></div>' if i != 4 else ""
        return (f"<html><body><nav>Menu</nav><article><h1>Daily</h1><p>Own {i} text</p>{box}<p>{near or f'More {i}'}</p>"
                f"<p>All rights are ours</p></article></body></html>")
    rows = [(i, f"https://a.org/{i}", page(i, "What most quote" if i > 2 else "")) for i in range(8)]
    rows += [(20 + i, "https://same.org/", page(0)) for i in range(4)]  # alike throughout
    rows += [(30 + i, f"https://two.org/{i}", page(i)) for i in range(2)]  # too few pages to tell
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole = "Daily\n\nOwn {0} text\n\nGet our letter\n\nEvery week\n\nMore {0}\n\nAll rights are ours"
    want = [(i, f"Daily\n\nOwn {i} text\n\n" + ("What most quote" if i > 2 else f"More {i}")) for i in range(8)]
    want += [(20 + i, whole.format(0)) for i in range(4)] + [(30 + i, whole.format(i)) for i in range(2)]
    assert bag(template.op4_template(table), "page_id", "text") == sorted(want, key=repr)


def test_template_classes_of_repeated_rows(spark):
    """Marks of equal rows must add up: here B is on the rows 0 and 1, each there twice, C on 2 and 3."""
    def page(i):
        b = "<div class=b><p>Both of B</p></div>" if i < 2 else ""
        c = "<div class=b><p>Both of C</p></div>" if i > 1 else ""
        return f"<body>{c if i == 3 else b}{b if i == 3 else c}<p>Own {i}</p></body>"
    rows = [(i, f"https://a.org/{i}", page(i)) for i in range(4) for _ in range(2)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    seen = {}
    real = template.stored
    template.stored = lambda df, label: seen.setdefault(label, real(df, label))
    try:
        template.extract(table)
    finally:
        template.stored = real
    classes = {c.token: c["class"] for r in seen["templates"].collect() for c in r.candidates}
    keys = {t.key: t for i in range(4) for t in template.tokens(page(i)) if t.key and t.text}
    found = {k[-9:]: classes[template._hash(k)] for k in keys if template._hash(k) in classes}
    assert set(found) >= {"Both of B", "Both of C"} and found["Both of B"] != found["Both of C"]


def brute_passages(text, name, body, t=licenses.THRESHOLD):
    """The best Dice of all passages of a text, up to the template's upper size bound."""
    pairs = lambda w: [f"{a} {b}" for a, b in zip(w, w[1:])]
    grams, words = pairs(licenses.normal_words(body)), pairs(licenses.normal_words(text))
    bag, most = set(grams), int(len(grams) * (2 - t) / t + 1e-9)
    best = 0
    for i in range(len(words)):
        seen, hits = set(), 0
        for w in words[i:i + most]:
            if w not in seen:
                seen.add(w)
                hits += w in bag
            best = max(best, 2 * hits / (len(seen) + len(bag)))
    return best


def test_licenses_wrapped_and_in_full(spark):
    rnd = np.random.default_rng(6)
    prose = " ".join(rnd.choice(["the", "sea", "software", "of", "license", "copy", "under", "any", "licensed"], 400))
    wrap = lambda body, n: "\n".join(" * " + " ".join(body.split()[i:i + n]) for i in range(0, len(body.split()), n))
    texts, every = {}, licenses.TEMPLATES | licenses.full_texts()
    for k, name in enumerate(("MIT-grant", "GPL-3.0-header", "BSD-2-Clause-header", "MPL-2.0", "ISC", "Apache-2.0-header")):
        texts[k] = (name, f"/*\n{wrap(every[name], 9)}\n */\n{prose}\n{prose}")
    texts[10] = ("MIT", f"{prose} It was Released under the MIT License. {prose}")
    texts[11] = ("MIT-text", f"MIT License\n\nCopyright (c) 2020 Some One\n\n{every['MIT-text']}")
    texts[12] = ("Apache-2.0-text", every["Apache-2.0-text"])
    texts[13] = ("ISC", f"{prose}\n{wrap(every['ISC'].replace('distribute', 'hand on'), 7)}\n{prose}\n{wrap(every['ISC'], 5)}\n{prose}")
    texts[14] = (None, f"{prose}\n{prose}")
    table = spark.createDataFrame([(k, t) for k, (_, t) in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.op9_licenses(table).collect()}
    for k, (name, text) in texts.items():
        got = set(filter(None, rows[k].licenses.split(",")))
        assert got == {n for n, b in every.items() if len(b) < 2000 and brute_passages(text, n, b) >= 0.8} | {name} - {None}, k
    assert rows[12].n_units > 1 and rows[11].best_dice == 1.0 and rows[14].n_units == 0 and rows[13].n_units == 2
    plan = licenses.op9_licenses(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("Scan")[0]


def test_licenses_altered_full_text(spark):
    """A changed word every few words makes many starts and ends; each start takes one pass."""
    body = licenses.full_texts()["GPL-2.0-text"]
    altered = lambda n: " ".join(f"zz{i}" if i % n == 0 else w for i, w in enumerate(body.split()))
    table = spark.createDataFrame([(n, altered(n)) for n in (40, 20, 4)], "doc_id long, text string")
    begin = time.monotonic()
    rows = {r.doc_id: r for r in licenses.op9_licenses(table).collect()}
    assert time.monotonic() - begin < 60
    for n in (40, 20):
        assert rows[n].best_license == "GPL-2.0-text"
        assert rows[n].best_dice == round(brute_passages(altered(n), "GPL-2.0-text", body), 6)
    assert "GPL-2.0-text" not in rows[4].licenses


def test_substring_repeated_rows_cost_their_number(spark):
    """Rows that repeat id and text give their own strings each, not one for every pair."""
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words))] + [(2, " ".join(["front", *words[100:300], "back"]))] * 40
    seen, real = {}, substring.stored
    substring.stored = lambda df, label: seen.setdefault(label, real(df, label))
    try:
        got = substring.op5_substring(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    finally:
        substring.stored = real
    spans = {r.sid: len(r.spans) for r in seen["spans"].collect()}
    assert seen["super-k-mers"].filter("id = 2").count() == 40 * spans[2]
    covered = {r.sid: r.starts for r in seen["covered"].collect()}
    assert sorted(covered) == [2] and sorted(covered[2]) == list(range(1, 152))
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0)] + [(2, 200)] * 40


def test_substring_one_context_of_many_strings(spark):
    """Strings of one crowded bucket that are alike on one side go to many tasks."""
    rnd = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(60)]
    docs = [(i, " ".join([*(f"x{v}" for v in rnd.integers(0, 10**6, 60)), *passage, "same", "end"])) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in substring.cut_repeats(table, crowd=8).selectExpr("id AS doc_id", "n_removed").collect()}
    assert got == {i: 0 if i == 0 else 62 for i in range(300)}


def test_winnowing_of_short_edited_texts(spark):
    rnd = np.random.default_rng(8)
    texts = ["".join(rnd.choice(list("abcdefghijklmnop "), n)) for n in rnd.integers(48, 190, 80)]
    rows = winnow.op10_winnowing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == 80 and all(r.near_edited > r.near_next for r in rows)
    assert all(r.fingerprint == winnow.as_text(winnow.fingerprint(texts[r.doc_id], 8, 16)) for r in rows)
