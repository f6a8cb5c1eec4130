"""Text, number and payment rules on the edge rows of FIXTURES §3."""

import random

import pytest
from pyspark.sql import functions as F

from tillstack.functions import numeric as N
from tillstack.functions import text as T
from tillstack.operators import clean as CL

# item text, variation, size, flavor, sugar, spice, qty, item before title-casing
EDGE_ROWS = [
    ("Latte (Hot) x2", "Hot", None, None, None, None, 2.0, "Latte"),
    ("iced mocha COLD", "Cold", None, None, None, None, 1.0, "iced mocha COLD"),
    ("Shot Glass x 3", "Hot", None, None, None, None, 3.0, "Shot Glass"),
    ("Cheesecake - DUO", None, "Duo", None, None, None, 1.0, "Cheesecake - DUO"),
    ("French Fries - BBQ x1", None, None, "Bbq", None, None, 1.0, "French Fries - BBQ"),
    ("Lemonade sour cream", None, None, "Sour Cream", None, None, 1.0, "Lemonade sour cream"),
    ("Latte Plain", None, None, None, None, None, 1.0, "Latte Plain"),
    ("Tea Sugar 50% x2", None, None, None, "Sugar 50%", None, 2.0, "Tea Sugar 50%"),
    ("Noodles Spicy (3/4)", None, None, None, None, "Spicy (3/4)", 1.0, "Noodles Spicy"),
    ("Mix 3 Platter x2", None, None, None, None, None, 3.0, "Mi Platter"),
    ("Bun X2", None, None, None, None, None, 1.0, "Bun X2"),
    ("Croissant - almond nutella x1", None, None, None, None, None, 1.0, "Croissant - almond nutella"),
    ("Croffle Biscoff Caramel", None, None, None, None, None, 1.0, "Croffle - Biscoff"),
    ("Nutella Pecan Cookie x4", None, None, None, None, None, 4.0, "Cookies - Nutella Pecan"),
    ("Cookies - Nutella Pecan", None, None, None, None, None, 1.0, None),
    ("Croissant x2", None, None, None, None, None, 2.0, None),
    ("Water x0", None, None, None, None, None, 0.0, "Water"),
    ("Cake (a) big (b) end", None, None, None, None, None, 1.0, "Cake end"),
    ("Box x12 x3", None, None, None, None, None, 12.0, "Box"),
    ("valentine's set", None, None, None, None, None, 1.0, "valentine's set"),
]


def test_edge_rows(spark):
    df = spark.createDataFrame([(r[0],) for r in EDGE_ROWS], "p string")
    p = F.col("p")
    got = df.select(
        "p", T.extract_variation(p).alias("v"), T.extract_size(p).alias("s"),
        T.extract_flavor(p).alias("f"), T.extract_sugar(p).alias("g"),
        T.extract_spice(p).alias("sp"), T.extract_quantity(p).alias("q"),
        T.clean_item(p).alias("item"),
    ).collect()
    by_text = {r["p"]: tuple(r)[1:] for r in got}
    for row in EDGE_ROWS:
        assert by_text[row[0]] == row[1:], row[0]


def test_blank_and_whitespace_items(spark):
    raw = spark.createDataFrame(
        [("\tTea , ,nan", "f", 1, 0)], "products string, source_file string, row_idx long, row_part long")
    out = CL.drop_blank_items(CL.explode_items(raw)).select("pos", "product_list").collect()
    assert [(r.pos, r.product_list) for r in out] == [(0, "Tea"), (2, "nan")]


def test_title_case_matches_python(spark):
    rnd = random.Random(7)
    alphabet = "abcXYZ éÉß'-/ 3(\t)ñÑöÖ.,_"
    samples = ["valentine's set", "3d a-b", "BBQ", "", "  x", "o'NEIL-smith", "w/cream", "a\u0000 b"]
    samples += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(T.title_case(F.col("s"))).collect()]
    assert got == [s.title() for s in samples]
    assert df.limit(1).select(T.title_case(F.lit(None).cast("string"))).first()[0] is None


@pytest.mark.parametrize("text,expected", [
    ("1,250.00", 1250.0), ("-", None), ("", None), ("abc", None), ("1d", None),
    (" 12 ", 12.0), ("1e3", 1000.0), ("1.005", 1.0), ("0.125", 0.12), ("2.675", 2.68),
    ("1234.565", 1234.56), ("nan", None), (None, None),
])
def test_amounts(spark, text, expected):
    got = spark.createDataFrame([(text,)], "a string").select(N.amount("a")).first()[0]
    assert got == expected


@pytest.mark.parametrize("cash,gcash,expected", [
    ("0", "150", "Free/Voucher/Discounted"), ("0.00", "-", "Free/Voucher/Discounted"),
    ("0.0", "-", "Cash"), ("150", "-", "Cash"), (None, "-", "Cash"),
    ("-", "150", "Gcash"), ("-", None, "Gcash"), ("-", "-", "Credit / Debit"),
])
def test_payment_type(spark, cash, gcash, expected):
    df = spark.createDataFrame([(cash, gcash)], "cash string, gcash string")
    assert df.select(N.payment_type(F.col("cash"), F.col("gcash"))).first()[0] == expected


def test_payment_type_missing_columns(spark):
    df = spark.createDataFrame([("-",)], "cash string")
    assert df.select(N.payment_type(None, F.col("cash"))).first()[0] == "Free/Voucher/Discounted"
    assert df.select(N.payment_type(F.col("cash"), None)).first()[0] == "Credit / Debit"


def test_word_search_equals_the_regex(spark):
    """Plain search of words gives what the case-insensitive regex gives: several words
    in a text, words in each other, letters that only Unicode case makes equal, null."""
    texts = [r[0] for r in EDGE_ROWS] + [
        "Cold brew HOT", "hot COLD", "Hotel duo SOLO solo", "cold\u00e9 hot", "\u017folo", "Medi\u0131o s\u0130ze solo", "fries sour cream BBQ mango",
        "\u017fugar 50%", "Mild (1/4) Spicy (3/4)", "COO\u212aIE oreo", "cookies & cookie Oreo", "", "x", "(", "a) b (c", "\u00a0Hot\u00a0(x)", None]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    for words in (["Solo", "Duo", "Medio", "Familia"], ["Hot", "Cold"], ["Cookies", "Cookie"], ["Cookie", "Cookies"], ["Sour Cream", "BBQ"], ["Sugar 50%"], ["Caf\u00e9"], []):
        regex = T.titled_match(T.extract_first("p", words), words)
        held = F.coalesce(F.col("p").rlike("(?iu)" + T.alternation(words)), F.lit(False))
        for r in df.select("p", T._vocab("p", words).alias("a"), regex.alias("b"), T.contains_any("p", words).alias("c"), held.alias("d")).collect():
            assert (r.a, r.c) == (r.b, r.d), (words, r)
    assert df.filter(T.ascii_lower("p") != F.lower("p")).isEmpty()


def test_space_class_is_python_white_space():
    import re
    chars = "".join(map(chr, range(0x3100)))
    python_class = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\u" + m[1].zfill(4), T.SPACE)
    assert "".join(re.findall(python_class, chars)) == T.PY_WHITESPACE


def test_parse_runs_as_compiled_methods(run):
    """A parse of more byte code than the JVM compiles in one method stays out of whole-stage code."""
    assert int(run.spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_dedup_first_parses_the_report_once(spark, tiny_dir, monkeypatch):
    from tillstack.plans import queries as Q
    calls, parse = [], CL.finished_lines
    monkeypatch.setattr(CL, "finished_lines", lambda *a, **k: calls.append(1) or parse(*a, **k))
    run = Q.Run(spark, tiny_dir)
    got = {tuple(r) for r in Q.q_dedup_first(run).select(*Q.KEYS).collect()}
    assert len(calls) == 1
    kept = CL.drop_footer(run.finished).join(CL.dedup_first(CL.drop_footer(run.finished)), Q.KEYS, "left_anti")
    assert got == {tuple(r) for r in kept.select(*Q.KEYS).collect()}
