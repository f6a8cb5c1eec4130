"""Report → clean item lines (MDL8: GEN1, FLT1-3, STR1-13, NUM1-5, PRJ1-4, WIN2).

Every step is a DataFrame → DataFrame function so they chain with
``DataFrame.transform`` and can be tested one by one.  Nothing runs per row
in Python.  The two steps that depend on file order (footer drop, keep-first
dedup) avoid windows over a file or a key: a file or key may hold a third of
all rows, and a window would put all of them in one task.  A partial aggregate
per (file, key) keeps the first line whole and the group's last place, and a
file's last line is one small row from those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstack import fixed_values as FV
from tillstack.functions import numeric as N
from tillstack.functions import text as T
from tillstack.sources.reports import ORDER_COLS
from tillstack.sources.seeds import Vocabulary, bounded_broadcast, category_lookup, corrections_lookup

LINE_ORDER = ["source_file", *ORDER_COLS, "pos"]


def order_fields(df: DataFrame) -> DataFrame:
    """NUM1-3 on the report row, before the explode: amounts and payment type
    belong to the order, so they are parsed once per order, not per item."""
    out = add_payment_type(df)
    amounts = {c: N.amount(c) for c in ("received_amount", "product_amount") if c in df.columns}
    return out.withColumns(amounts) if amounts else out


def explode_items(df: DataFrame) -> DataFrame:
    """GEN1: one row per comma-separated item; a null cell reads as ``nan``."""
    cell = F.coalesce(F.col("products"), F.lit(FV.MISSING_TEXT))
    return df.select("*", F.posexplode(F.split(cell, ",")).alias("pos", "product_text"))


def drop_blank_items(df: DataFrame) -> DataFrame:
    """FLT1: drop blank items, keep the stripped text as ``product_list``."""
    stripped = T.strip_ws("product_text")
    return df.filter(stripped != "").withColumn("product_list", stripped).drop("product_text")


def extract_attributes(df: DataFrame, rules: T.TextRules = T.DEFAULT_RULES) -> DataFrame:
    """STR1-6 on ``product_list``."""
    p, low = F.col("product_list"), F.col("_low") if "_low" in df.columns else None
    return df.withColumns({
        "size": T.extract_size(p, rules, low),
        "variation": T.extract_variation(p, rules, low),
        "flavor": T.extract_flavor(p, rules, low),
        "sugar_level": T.extract_sugar(p, rules, low),
        "spice_level": T.extract_spice(p, rules, low),
        "quantity": T.extract_quantity(p, rules),
    })


def derive_item(df: DataFrame, rules: T.TextRules = T.DEFAULT_RULES) -> DataFrame:
    """STR7-12: composite pastry names or cleaned plain names."""
    return df.withColumn("clean_item", T.clean_item("product_list", rules, F.col("_low") if "_low" in df.columns else None))


def apply_corrections(df: DataFrame, spark: SparkSession, vocab: Vocabulary) -> DataFrame:
    """STR13: exact-value corrections by a broadcast left join."""
    fixes = corrections_lookup(spark, vocab)
    if fixes.rows == 0:
        return df
    joined = df.join(fixes.hinted(), F.col("clean_item") == F.col("fix_from"), "left")
    return joined.withColumn("clean_item", F.coalesce("fix_to", "clean_item")).drop("fix_from", "fix_to")


def categorize(df: DataFrame, spark: SparkSession, vocab: Vocabulary) -> DataFrame:
    """NUM5: item → sub-category → category, exact case; a miss is null."""
    look = category_lookup(spark, vocab)
    joined = df.join(look.hinted(), F.col("clean_item") == F.col("lookup_item"), "left")
    return (joined.withColumnRenamed("lookup_sub_category", "sub_category")
            .withColumnRenamed("lookup_category", "category").drop("lookup_item"))


def add_payment_type(df: DataFrame) -> DataFrame:
    """NUM3 (absent cash/gcash columns handled as the text rule says)."""
    cash = F.col("cash") if "cash" in df.columns else None
    gcash = F.col("gcash") if "gcash" in df.columns else None
    return df.withColumn("payment_type", N.payment_type(cash, gcash))


def keep_columns(df: DataFrame, extra=()) -> DataFrame:
    """PRJ1: listed columns that exist, in order, plus lineage."""
    keep = [c for c in FV.KEEP_COLUMNS if c in df.columns]
    lineage = [c for c in [*LINE_ORDER, *extra] if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in keep + lineage])


def drop_missing_items(df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    """FLT2: a null item (unparsed pastry, null cell) or the text ``nan``.

    ``keep_unparsed`` (Q3) keeps pastry lines whose flavor was not
    recognised (null item, real product text), so they reach quarantine as
    ``Null item name`` instead of vanishing."""
    kept = F.col("clean_item").isNotNull() & (F.col("clean_item") != FV.MISSING_TEXT)
    if keep_unparsed and "product_list" in df.columns:
        kept = kept | (F.col("clean_item").isNull() & (F.col("product_list") != FV.MISSING_TEXT))
    return df.filter(kept)


def finish_columns(df: DataFrame) -> DataFrame:
    """STR11 title-case, PRJ2 renames, PRJ4 defaults (amounts were parsed
    per order by ``order_fields``)."""
    out = df.withColumn("clean_item", T.title_case("clean_item"))
    if "type/channel" in out.columns:
        channel = F.col("`type/channel`")
        merged = F.coalesce("order_type", channel) if "order_type" in out.columns else channel
        out = out.withColumn("order_type", merged).drop("type/channel")
    out = out.withColumnsRenamed({"clean_item": "items", "product_amount": "total_order_amount"})
    return out.withColumns({
        "category": F.coalesce("category", F.lit(FV.UNCATEGORIZED)),
        "sub_category": F.coalesce("sub_category", F.lit(FV.UNCATEGORIZED)),
    })


def _ordinal_select(agg_col: str) -> list:
    return [F.col(f"{agg_col}.{c}").alias(c) for c in [*ORDER_COLS, "pos"]]


def drop_footer(df: DataFrame) -> DataFrame:
    """FLT3: drop the last surviving line of every file.

    Per file, ``max(ordinal)`` is a partial aggregate (one row per file per
    map task); the anti join on the full ordinal is planned by AQE from the
    measured size of that per-file result.
    """
    return df.join(file_lasts(df), on=LINE_ORDER, how="left_anti")


def dedup_first(df: DataFrame, keys=FV.DEDUP_KEYS) -> DataFrame:
    """WIN2: keep the first line (file order) of each key within each file.

    Keys compare nulls as equal (grouping).  The first ordinal per key is a
    partial aggregate; a semi join on the ordinal keeps exactly that line.
    """
    firsts = (df.groupBy("source_file", *keys)
              .agg(F.min(F.struct(*ORDER_COLS, "pos")).alias("m"))
              .select("source_file", *_ordinal_select("m")))
    return df.join(firsts, on=LINE_ORDER, how="left_semi")


LAST, COPIES = "last_place", "copies"


def first_lines(df: DataFrame, keys=FV.DEDUP_KEYS) -> DataFrame:
    """The first line of each (file, key) whole, with ``last_place`` and ``copies``: the
    last ordinal of its group and the group's size.  One partial aggregate: the first
    line is the smallest struct that starts with the ordinal.  Lineage columns are
    never null (the readers set them)."""
    others = [c for c in df.columns if c not in (*keys, *LINE_ORDER)]
    place = F.struct(*ORDER_COLS, "pos")
    line = F.struct(*ORDER_COLS, "pos", *[F.col(f"`{c}`") for c in others])
    grouped = df.groupBy("source_file", *keys).agg(F.min(line).alias("l"), F.max(place).alias(LAST), F.count(F.lit(1)).alias(COPIES))
    columns = {c: F.col(f"l.`{c}`") for c in [*ORDER_COLS, "pos", *others]}
    return grouped.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns], LAST, COPIES)


def drop_lasts(first: DataFrame, files: int | None = None) -> DataFrame:
    """``first_lines`` without each file's last line: a small row a file tells it.
    ``files``: how many there are, if known; few are broadcast."""
    lasts = (first.groupBy("source_file").agg(F.max(LAST).alias("m"))
             .select("source_file", *_ordinal_select("m")))
    return (first.join(bounded_broadcast(lasts, files), on=LINE_ORDER, how="left_anti")
            .select(*[c for c in first.columns if c not in (LAST, COPIES)]))


def keep_first_drop_last(df: DataFrame, keys=FV.DEDUP_KEYS, drop_last_row: bool = True, hold=None) -> DataFrame:
    """FLT3 + WIN2 in one aggregate.

    The footer drop runs before the dedup in the rule, and the last line of a file is
    either alone in its key group (so the group disappears) or a later copy (which the
    dedup drops anyway), so a line stays iff it is its group's first and not the file's
    last.  The lines are read twice then, for the files' last places and for the rest:
    ``hold`` writes them and reads them back, so that they are parsed once.  Their files
    are counted then: a join planned by its sizes shuffles the lines before it learns
    that the last places are a row a file."""
    first = first_lines(df, keys)
    first = hold(first) if hold else first
    files = first.select("source_file").distinct().count() if hold and drop_last_row else None
    out = drop_lasts(first, files) if drop_last_row else first
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def file_lasts(df: DataFrame) -> DataFrame:
    """The ordinal of every file's last line: a partial aggregate, a row a file."""
    return (df.groupBy("source_file").agg(F.max(F.struct(*ORDER_COLS, "pos")).alias("m"))
            .select("source_file", *_ordinal_select("m")))


def parse_lines(df: DataFrame, spark: SparkSession, vocab: Vocabulary) -> DataFrame:
    """Report rows → parsed, categorised item lines (before the final cleanup)."""
    return (df.transform(order_fields)
            .transform(explode_items)
            .transform(drop_blank_items)
            .withColumn("_low", T.ascii_lower("product_list"))
            .transform(lambda d: extract_attributes(d, vocab.rules))
            .transform(lambda d: derive_item(d, vocab.rules))
            .drop("_low")
            .transform(lambda d: apply_corrections(d, spark, vocab))
            .transform(lambda d: categorize(d, spark, vocab)))


def finished_lines(df: DataFrame, spark: SparkSession, vocab: Vocabulary | None = None,
                   keep_unparsed: bool = False, carry=()) -> DataFrame:
    """Parsed lines after FLT2 and the column cleanup, before the file-order
    steps.  ``carry``: columns of the report rows that the lines keep."""
    extra = (*carry, "product_list") if keep_unparsed else tuple(carry)
    out = (parse_lines(df, spark, vocab or Vocabulary())
           .transform(lambda d: keep_columns(d, extra))
           .transform(lambda d: drop_missing_items(d, keep_unparsed))
           .transform(finish_columns))
    return out.drop("product_list") if keep_unparsed else out


def clean_report(df: DataFrame, spark: SparkSession, vocab: Vocabulary | None = None,
                 drop_last_row: bool = True, keys=FV.DEDUP_KEYS, keep_unparsed: bool = False, hold=None, place=None, tasks: int | None = None) -> DataFrame:
    """MDL8: normalised report → clean item lines, in the reference order.

    One shuffle, of the report's rows before they are exploded: all lines that can be
    copies of each other are of one order, time and file, so the keep-first aggregate
    needs no other, and a row is a fraction of its lines.  An order's rows of a file go
    to one task, which sorts them (and spills).  The output keeps the lineage columns
    ``source_file, row_idx, row_part, pos``; ``conform`` drops what a load schema
    does not list.  ``hold``: see ``keep_first_drop_last``.  ``place`` shuffles the rows
    in another way and names the columns, made from the keys, that it goes by; the
    lines keep these columns.  ``tasks``: how many share the rows otherwise (else the session's number).
    """
    if place:
        df, by = place(df)
    else:
        # a number of its own: by their size the rows would be joined into few tasks, while the parse is the cost
        n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df, by = df.repartition(n, "source_file", *[k for k in keys if k in df.columns]), []
    lines = finished_lines(df, spark, vocab, keep_unparsed=keep_unparsed, carry=by)
    return keep_first_drop_last(lines, [*by, *keys], drop_last_row, hold)
