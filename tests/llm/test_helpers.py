"""Plain-Python parts against brute force."""

import random

import numpy as np
import public_tokenizers
import pytest
import xxhash

from tillstack.llm import licenses, packing, simhash, substring, template, topk, winnow
from tillstack.llm.common import laid_out, word_chunks


def brute_best_fit(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [(r, i) for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits)[1]] -= length
            else:
                rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_layout_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 16, 37, 64])
    counts = {n: rnd.randint(1, 9) for n in rnd.sample(range(1, capacity + 1), rnd.randint(1, capacity // 2))}
    taken = {}
    for length, runs in packing.best_fit_layout(counts, capacity).items():
        done = 0
        for first, end, sequence, each, offset in runs:
            assert first == done
            done = end
            for i in range(first, end):
                places = taken.setdefault(sequence + (i - first) // each, set())
                own = range(offset + (i - first) % each * length, offset + (i - first) % each * length + length)
                assert not places & set(own)
                places |= set(own)
        assert done == counts[length]
    assert all(p == set(range(len(p))) for p in taken.values())  # gapless
    assert sorted(capacity - len(p) for p in taken.values()) == brute_best_fit(counts, capacity)


def test_ids_are_those_of_the_tokenizers_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, fast = Tokenizer.from_file(path), packing.ByteBpe(path)
    texts = ["", " ", "x" * 5000 + " <|endoftext|> y" + " " * 3000 + "\n\n z", "it's 12 o'clock\t\n  ", "naïve 漢字 　 \x00"]
    texts += ["".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}." for c in range(a, a + 64)) for a in (0, 0x80, 0x370, 0x2000, 0x1F600)]
    for t in texts:
        assert fast.ids(t).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_word_chunks_keep_words_whole():
    data = b" \t".join(b"w%d" % i for i in range(1000)) + b"\n"
    assert [w for part in word_chunks(data, 50) for w in part] == data.split()
    text, begin, end = laid_out(data)
    assert [text[a:z] for a, z in zip(begin, end)] == data.split()


@pytest.mark.parametrize("text", ["", " \n", "one", "One two", "A b c d e f g a b c " * 30, "é ü Ü x" * 9])
def test_fingerprint_counts_bits(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want


def test_minimisers_belong_to_windows():
    rnd = random.Random(1)
    words = [rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(400)] + ["z"] * 120
    mini, _ = substring.window_minimisers(" ".join(words).encode())
    assert len(mini) == len(words) - 49
    by_window = {}
    for i, x in enumerate(mini.tolist()):  # equal windows, equal buckets
        assert by_window.setdefault(tuple(words[i:i + 50]), x) == x


@pytest.mark.parametrize("block", [1 << 18, 100])
def test_winnowing_takes_the_rightmost_minimum(monkeypatch, block):
    monkeypatch.setattr(winnow, "_BLOCK", block)
    rnd = random.Random(5)
    for text in ("ab" * 300, "x" * 200, "".join(rnd.choice("abc é漢") for _ in range(900)), "y" * 33):
        hashes = [int(h) >> 24 for h in winnow._grams(np.frombuffer(text.encode("utf-32-le"), "<u4"), 32)]
        want = []
        for i in range(max(1, len(hashes) - 63)):
            window = hashes[i:i + 64]
            place = i + max(j for j, h in enumerate(window) if h == min(window))
            if not want or want[-1][1] != place:
                want.append((min(window) >> 8, place))
        assert [tuple(x) for x in winnow.fingerprint(text, 32, 64).tolist()] == want
    assert len(winnow.fingerprint("")) == 0 and len(winnow.fingerprint("short")) == 1
    assert winnow.likeness(winnow.fingerprint(""), winnow.fingerprint("")) == 1.0


def test_top_candidates_are_exact_with_ties():
    rng = np.random.default_rng(0)
    c = rng.integers(-3, 4, (500, 6)).astype(float)
    q, pivots = c[:20], c[100:108]
    far = lambda x: np.linalg.norm(x[:, None] - pivots[None], axis=2)
    ids = np.arange(500)
    for i, rows, scores in topk._best(q, far(q), list(range(20)), c, far(c), ids, np.zeros(500, bool), 5, np.full(len(q), -np.inf)):
        want = sorted(((-(c[j] @ q[i]), j) for j in range(500) if j != i))[:5]
        assert [(-s, int(r)) for r, s in zip(rows, scores)] == want


def test_template_and_main_text():
    pages = [f"<html><body><nav><a>Home</a></nav><div class='cookie-notice'>We use</div><article><h1>T{i}</h1><p>One  {i}&amp;<br>three"
             f"<div class=ad>buy</div><ul><li>x<li>y</ul><section id=comments><p>c</p></section></article><p>Always here</p><footer>f" for i in range(3)]
    assert template.main_text(pages[0], {}) == "T0\n\nOne 0& three\n\nx\n\ny"
    assert template.main_text("<body><header>top</header><p>a</p><aside>b</aside><script>var x='</p>'</script>", {}) == "a"
    assert template.main_text("", {}) == "" and template.main_text("no markup", {}) == "no markup"
    keys = [[t.key for t in template.tokens(p) if t.key] for p in pages]
    once = [k for k in keys[0] if all(other.count(k) == 1 for other in keys)]  # one occurrence vector
    shared = {template._hash(k): (1, float(i)) for i, k in enumerate(once)}
    chosen = template.template_of(template.tokens(pages[0]), shared)
    texts = [t.text for i, t in enumerate(template.tokens(pages[0])) if i in chosen and t.text]
    assert "Always here" in texts and "T0" not in texts


def test_license_bounds():
    for name, grams, n in licenses.template_sizes(licenses.TEMPLATES):
        assert n >= len(grams) > 0, name


def test_attributes_are_read_as_whole_pairs():
    for mark in ('style="overflow:hidden"', 'title="The hidden valley"', 'data-id="share"', 'data-role="search"', "data-class='ad'",
                 "alt=hidden", 'title="class=ad"', "data-hidden"):
        assert template.main_text(f"<body><div {mark}><article {mark}><p>Own text</p></article></div>", {}) == "Own text", mark
    for mark in ("hidden", "HIDDEN=''", "aria-hidden=true", "aria-hidden='true' title=x", 'title="a b" id="share"', "data-x=1 role = 'search'", "class=ad"):
        assert template.main_text(f"<body><article><p>Own text</p><div {mark}>gone</div></article>", {}) == "Own text", mark


def test_template_classes_nest_beyond_any_number():
    found = [template.Token(k, None, "body", "div") for k in ["a"] + ["b", "c"] * 300 + ["x", "d", "y", "d"]]
    found.insert(400, template.Token("x", None, "body", "div"))
    shared = {template._hash(k): (n, float(i), 3) for i, (k, n) in enumerate((("b", 1), ("c", 1), ("x", 2), ("d", 3), ("y", 2)))}
    kept = template.template_of(found, shared)
    # x ... x y is not in its class's order; d stands alone
    assert {found[i].key for i in kept} == {"b", "c", "d"}
    rnd = random.Random(3)
    for _ in range(300):
        keys = [rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 14))]
        cut = rnd.randint(1, 7)
        shared = {template._hash(k): (i // 2 if i < cut else i, float(rnd.random()), 3) for i, k in enumerate("abcdefgh")}
        keys = [k for k in keys for _ in range(rnd.choice((1, 1, 40)))]
        want, spans = set(), []
        classes = {}
        for i, k in enumerate(keys):
            classes.setdefault(shared[template._hash(k)][0], []).append((i, template._hash(k)))
        for _, places in sorted(classes.items(), key=lambda x: (-len(x[1]), x[0])):
            order = sorted({h for _, h in places}, key=lambda h: (shared[h][1], h))
            m = len(order)
            if len(places) % m or [h for _, h in places] != order * (len(places) // m):
                continue
            new = [(places[j][0], places[j + m - 1][0]) for j in range(0, len(places), m)]
            if not any(a < c < b < d or c < a < d < b for a, b in new for c, d in spans):
                spans += new
                want |= {i for i, _ in places}
        assert template.template_of([template.Token(k, None, "body", "p") for k in keys], shared) == want


def test_a_class_of_many_stretches_can_be_crossed():
    keys = ["a", "b"] * 299 + ["a", "x", "b", "y"]
    shared = {template._hash(k): (c, float(i), 3) for i, (k, c) in enumerate((("a", 1), ("b", 1), ("x", 2), ("y", 2)))}
    kept = template.template_of([template.Token(k, None, "body", "p") for k in keys], shared)
    assert {keys[i] for i in kept} == {"a", "b"}  # x y crosses the last a b


def test_names_of_a_pages_state_keep_its_article():
    text = "<article><p>Hello there</p></article>"
    for page in (f'<body class="has-sidebar">{text}</body>', '<article class="post share-enabled"><p>Hello there</p></article>',
                 '<body class="nav-open"><main><p>Hello there</p></main></body>', '<body class="single comments-open"><p>Hello there</p>',
                 f'<body><form id="aspnetForm">{text}</form></body>', '<body><form><h1>Hello there</h1></form></body>',
                 f'<body><div class="no-ads content-with-sidebar">{text}</div></body>',
                 '<body><article><p class="notice-of-meeting">Hello there</p></article></body>'):
        assert template.main_text(page, {}) == "Hello there", page
    for mark in ("site-footer", "cookieBanner", "ad_slot", "newsletter-signup", "main-nav", "comment-list", "pageHeader"):
        assert template.main_text(f'<body><div class="{mark}">gone</div><p>Hello</p></body>', {}) == "Hello", mark
    assert template.main_text('<body><article><p>Hello</p><article class="comment">gone</article></article></body>', {}) == "Hello"
    assert template.main_text('<body><form><p>Your name</p></form><p>Hello</p></body>', {}) == "Hello"


def test_deep_pages_cost_in_proportion():
    page = "<div>" * 40000 + "deep" + "</em></span>" * 40000
    found = template.tokens(page)
    assert max(len(t.key) for t in found) < 64 and template.main_text(page, {}) == "deep"


def test_bpe_packs_places_and_ids():
    import pyarrow as pa

    from tillstack.llm import bpe
    words = [([{"block": 5, "j": 2}, {"block": -3, "j": 0}], [7, 8, 900000], None), ([{"block": 5, "j": 0}], None, "b"), ([{"block": -3, "j": 9}], [2, 3], None)]
    kind = pa.list_(pa.struct([("block", pa.int64()), ("j", pa.int32())]))
    batches = [pa.RecordBatch.from_arrays([pa.array([p], kind), pa.array([t], pa.list_(pa.int32())), pa.array([w], pa.string())],
                                          ["places", "tokens", "word"]) for p, t, w in words]
    got = {}
    for b in bpe._packed({b"a": 0, b"b": 1})(iter(batches)):
        for block, packed in zip(b.column(0).to_pylist(), b.column(1)):
            number, ids = bpe._unpacked(pa.chunked_array([pa.array([packed.as_py()], pa.binary())]))
            got[block] = dict(zip(number.tolist(), ids.to_pylist()))
    assert got == {5: {0: [1], 2: [7, 8, 900000]}, -3: {0: [7, 8, 900000], 9: [2, 3]}}
