"""A raw point-of-sale report derived from the test tables.

One report row per order (``orders``), whose ``Products`` cell lists the
order's lines (``lineitem``) as free text, plus one blank footer row per
monthly report file.  Headers come as delivered (``Order ID`` …) so the
pipeline's header normalisation runs too.

Plan: the needed line fields are grouped into report cells by
``(l_orderkey, cell)``.  Part of the report's definition, not of the engine: an
order is delivered as one row for each ``CELL_LINES`` line numbers (the cell is
``(l_linenumber - 1) div CELL_LINES``), so a long order is several rows at every
size of the data.  Item text is built on the reducers after ordering each
cell, and cells are left-joined to ``orders`` (unique per key) with a
sort-merge join.  Footers are one partial aggregate per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Report rows hold at most this many line numbers per cell.
CELL_LINES = 32
FOOTER_ROW_IDX = 9223372036854775807

# Item text templates, picked by l_partkey; {V} {S} {F} {G} {P} are filled
# from the option lists below by the remainders given in ``SLOTS``.
TEMPLATES = [
    "Americano{V}", "Mocha{V}", "Cinnamon Latte{V}", "Hojicha Float{V}", "Oolong Milk (Cold){G}",
    "Ginger Lemonade{F}", "Sweet Potato Fries{F}", "Mint Infusion (Hot)", "Pandan Tart{S}", "Harvest Sandwich{S}",
    "Chili Udon{P}", "Croffle Oreo", "Croffle caramel", "Smores Cookie", "Red Velvet Cookie", "Matcha Cookie",
    "Croissant Almond Nutella", "Butter Croissant", "Espresso Shot", "Bowl of Rice", "Scented Candle", "Mystery Box",
    "Mocca{V}", "cinnamon latte{V}", "Farmer's Omelette", "抹茶latte", "Sparkling Water", "Mushroom Rice Bowl",
]
SLOTS = {
    "{V}": ("l_linenumber", [" (Hot)", " (Cold)", ""]),
    "{S}": ("l_linenumber", [" (Solo)", " (Duo)", " (Medio)", " (Familia)", ""]),
    "{F}": ("l_suppkey", [" (Cheese)", " (BBQ)", " (Sour Cream)", " (Plain)", " (Mango)", ""]),
    "{G}": ("l_suppkey", [" (Sugar 20%)", " (Sugar 50%)", " (Sugar 75%)", " (Sugar 100%)", ""]),
    "{P}": ("l_linenumber", [" (Mild (1/4))", " (Regular (2/4))", " (Spicy (3/4))", ""]),
}


def _pick(options, key: Column) -> Column:
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, (F.pmod(key, F.lit(len(options))) + 1).cast("int"))


def item_text(get=F.col) -> Column:
    """Free-text item for one line, e.g. ``Mocha (Cold) x3``; ``get`` maps a
    lineitem column name to a Column (a struct field inside a lambda)."""
    text = _pick(TEMPLATES, get("l_partkey"))
    for slot, (key, options) in SLOTS.items():
        text = F.replace(text, F.lit(slot), _pick(options, get(key)))
    q = get("l_quantity").cast("int")
    qty = (F.when(F.pmod(q, F.lit(17)) == 0, F.lit(" x0"))
           .when(F.pmod(q, F.lit(5)) == 0, F.lit(""))
           .when(F.pmod(q, F.lit(11)) == 0, F.lit(" x\u00a02"))  # as spreadsheets deliver it
           .otherwise(F.concat(F.lit(" x"), (F.pmod(q, F.lit(4)) + 1).cast("string"))))
    return F.concat(text, qty)


def _money(c: Column) -> Column:
    return F.format_number(c, 2)


def _paid_at() -> Column:
    """When an order was paid."""
    secs = F.pmod(F.col("o_orderkey") * 37, F.lit(46800)) + 25200
    return F.timestamp_add("SECOND", secs, F.col("o_orderdate"))


def raw_report(spark: SparkSession, sf_dir: str, only=None) -> DataFrame:
    """The delivered report (un-normalised headers) with lineage columns.  ``only``: a
    condition on an order key, by its column's name; the rows of other orders are not put
    together then (the footers stay)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")

    if only:
        li = li.filter(only("l_orderkey"))

    # The raw line fields are shuffled and the item text is built on the
    # reducers, after ordering the cell's lines.
    lines = li.select(
        "l_orderkey",
        F.floor((F.col("l_linenumber") - 1) / CELL_LINES).cast("long").alias("cell"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_shipdate", "l_quantity").alias("line"),
    )
    cells = lines.groupBy("l_orderkey", "cell").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: item_text(lambda n: x[n])), ", ")
        .alias("products")
    )

    o = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.concat(F.lit("report_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".csv")).alias("source_file"),
    )
    # ``cells`` grows with lineitem: never broadcast it, whatever its
    # estimated size; a sort-merge join on the order key keeps the report
    # spread over the shuffle partitions.
    sold = o.filter(only("o_orderkey")) if only else o
    rows = sold.join(cells.hint("merge"), sold.o_orderkey == cells.l_orderkey, "left")

    k = F.col("o_orderkey")
    ts = _paid_at()
    prio = F.col("o_orderpriority")
    amount_text = _money(F.col("o_totalprice"))
    report = rows.select(
        F.when(F.pmod(k, F.lit(997)) == 0, F.lit(None)).otherwise(k.cast("string")).alias("Order ID"),
        F.col("products").alias("Products"),
        F.when(F.pmod(k, F.lit(101)) == 0, F.lit("-")).otherwise(amount_text).alias("Product Amount"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit("-"))
        .otherwise(_money(F.col("o_totalprice") + F.pmod(F.col("o_custkey"), F.lit(5)) * 50.0))
        .alias("Received Amount"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("Payment Time"),
        (F.when(prio == "1-URGENT", F.when(F.pmod(k, F.lit(2)) == 0, F.lit("0")).otherwise(F.lit("0.00")))
         .when(prio == "2-HIGH", F.when(F.pmod(k, F.lit(7)) == 0, F.lit("0.0")).otherwise(amount_text))
         .when(prio.isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit("-"))).alias("Cash"),
        F.when(prio == "3-MEDIUM", amount_text).otherwise(F.lit("-")).alias("GCash"),
        (F.when(F.col("o_orderstatus") == "O", F.lit("Dine-in"))
         .when(F.col("o_orderstatus") == "F", F.lit("Takeaway"))
         .when(F.pmod(k, F.lit(50)) == 0, F.lit("Delivery"))
         .otherwise(F.lit("Dine-in"))).alias("Type/Channel"),
        "source_file",
        k.alias("row_idx"),
        F.coalesce(F.col("cell"), F.lit(0)).cast("long").alias("row_part"),
    )

    footers = o.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).select(
        *[F.lit(None).cast("string").alias(c) for c in
          ["Order ID", "Products", "Product Amount", "Received Amount", "Payment Time",
           "Cash", "GCash", "Type/Channel"]],
        "source_file",
        F.lit(FOOTER_ROW_IDX).cast("long").alias("row_idx"),
        F.lit(0).cast("long").alias("row_part"),
    )
    return report.unionByName(footers)


def normalized_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstack.sources.reports import normalize_headers
    return normalize_headers(raw_report(spark, sf_dir))


def daily_report(spark: SparkSession, sf_dir: str, only=None) -> DataFrame:
    """The same orders as daily report files: one file per payment day with
    a blank footer row last, as delivered (``report_date`` names the day).  ``only``: see
    ``raw_report``."""
    rows = (raw_report(spark, sf_dir, only).filter(F.col("row_idx") != FOOTER_ROW_IDX)
            .withColumn("report_date", F.to_date(F.col("Payment Time").cast("timestamp_ntz"))))
    # the days with a row: an order has one at least, so they are told without its lines
    days = (spark.read.parquet(f"{sf_dir}/orders.parquet").filter(F.col("o_orderkey") != FOOTER_ROW_IDX)
            .select(F.to_date(_paid_at()).alias("report_date")).distinct())
    footers = days.select(
        *[F.lit(None).cast("string").alias(c) for c in
          ["Order ID", "Products", "Product Amount", "Received Amount", "Payment Time",
           "Cash", "GCash", "Type/Channel"]],
        F.lit(None).cast("string").alias("source_file"),
        F.lit(FOOTER_ROW_IDX).cast("long").alias("row_idx"),
        F.lit(0).cast("long").alias("row_part"),
        "report_date",
    )
    return rows.unionByName(footers)
