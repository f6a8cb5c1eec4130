"""The pipeline's rows after each stage, against brute force on a small fixture."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tillstack.llm import packing, quality, simhash
from tillstack.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, folder):
    rnd = np.random.default_rng(11)
    vocabulary = [a + b + c for a in ("mar", "tel", "so", "qui", "ven") for b in ("a", "el", "o", "in") for c in ("ta", "ros", "lim", "den", "k")]
    prose = lambda n: " ".join(rnd.choice(vocabulary, n)) + "."
    passage, texts = prose(70), {}
    for i in range(40):
        texts[i] = prose(int(rnd.integers(60, 400)))
    for i in range(40, 60):
        texts[i] = "BUY!! NOW!! | $$$ | ### | WIN!! " * int(rnd.integers(2, 9))
    texts |= {60: texts[3], 61: texts[5] + " end", 62: texts[7].replace("\x20", "  ", 3)}  # copies, exact and near
    texts |= {63: f"{prose(80)}\n {passage} {prose(40)}", 64: f"{prose(90)}  {passage}\t{prose(30)}", 65: passage + " " + prose(50)}
    texts |= {66: None, 67: "", 68: prose(9000), 69: texts[40]}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(not 40 <= i < 60)) for i in range(70)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return texts


def near_groups(texts):
    """Ids of the smallest member of each group of fingerprints linked at 3 bits or fewer."""
    order = sorted(texts)
    prints = {i: simhash.fingerprint((texts[i] or "").encode()) for i in order}
    least = {i: i for i in order}
    for _ in order:
        for i in order:
            for j in order:
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    least[i] = least[j] = min(least[i], least[j])
    return {least[i] for i in order}


def without_repeats(texts, k=50):
    owner, out = {}, {}
    for i in sorted(texts):
        words = (texts[i] or "").split()
        gone = set()
        for at in range(len(words) - k + 1):
            if owner.setdefault(tuple(words[at:at + k]), i) < i:
                gone |= set(range(at, at + k))
        out[i] = " ".join(w for at, w in enumerate(words) if at not in gone) if gone else texts[i] or ""  # a null text comes out empty
    return out


def sequences_needed(lengths, capacity):
    """Best-fit decreasing, one piece after another."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - n)
    return len(rooms)


def test_pipeline_rows_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    texts = fixture(spark, folder)
    docs = read_table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    as_texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    model = quality.train(docs, read_table(spark, folder, "labels"))
    ids = sorted(texts)
    scores = model.score(quality.dense([quality.features((texts[i] or "").encode()) for i in ids]))
    want = {i: texts[i] for i, s in zip(ids, scores) if s >= quality.THRESHOLD}
    assert not set(range(40, 60)) & set(want) and set(range(40)) <= set(want)
    kept = stages["quality_filter"](spark, docs, folder)
    assert kept.columns == docs.columns and as_texts(kept) == want

    want = {i: want[i] for i in near_groups(want)}
    assert 60 not in want and 3 in want
    kept = stages["near_dedup"](spark, kept, folder)
    assert kept.columns == docs.columns and as_texts(kept) == want

    want = without_repeats(want)
    assert want[64] != texts[64] and want[63] == texts[63]
    kept = stages["substring_dedup"](spark, kept, folder)
    assert kept.columns == docs.columns and as_texts(kept) == want
    assert {r.doc_id: r.n_chars for r in kept.collect()} == {i: len(t or "") for i, t in want.items()}

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in want.items()}
    for packed in (stages["best_fit_packing"](spark, kept, folder).collect(), corpus_pipeline.run(spark, folder).collect()):
        pieces, sequences = {}, {}
        for r in packed:
            pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert set(pieces) == set(want)
        for i, found in pieces.items():
            found.sort()
            assert [p for p, *_ in found] == list(range(len(found)))
            assert [s for _, s, *_ in found] == np.cumsum([0] + [n for _, _, n, _ in found[:-1]]).tolist()
            assert sum(n for _, _, n, _ in found) == len(tokens[i]) and all(n == packing.CAPACITY for _, _, n, _ in found[1:])
            assert all(c == zlib.crc32(tokens[i][s:s + n].tobytes()) for _, s, n, c in found)
        for places in sequences.values():
            places.sort()
            assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places[:-1]]).tolist()
            assert sum(n for _, n in places) <= packing.CAPACITY
        assert len(sequences) == sequences_needed([r.length for r in packed], packing.CAPACITY)
