"""Dimensions (MDL1-7, WIN1, SRC9, GEN2, DAT1-3, JN8, NUM6)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillstack.functions.dates import date_key
from tillstack.sources import seeds
from tillstack.sources.seeds import Sized, Vocabulary, bounded_broadcast
from tillstack.sources.sinks import Table


def dim_product(seed: Sized, key: str = "row_number") -> Sized:
    """MDL1: catalog rows numbered by (category, sub_category, items,
    variation, size), nulls first.  The window has no partition key: it runs
    in one task, which is right for a catalog (its size is ``seed.rows``).

    ``key="hash"`` (Q11) gives a key that does not shift when the catalog
    grows: ``xxhash64`` of the natural key (items, variation, size)."""
    if key == "hash":
        k = F.xxhash64("items", "variation", "size").alias("product_key")
    else:
        w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in
                             ["category", "sub_category", "items", "variation", "size"]])
        k = F.row_number().over(w).cast("int").alias("product_key")
    df = seed.df.select(k, "items", "sub_category", "category", "variation", "size")
    return Sized(df, seed.rows)


NATURAL_KEY = ["items", "variation", "size"]
_ORDER = ["category", "sub_category", "items", "variation", "size"]


def register_products(seed: Sized, known: Sized | None) -> Sized:
    """MDL1 with keys that stay (Q11): products of ``known`` (an earlier result) keep
    their key, new ones are numbered after the highest, in ``dim_product``'s order.
    Known products take the seed's grouping; those that the seed no longer lists stay,
    as facts refer to them.  The natural key decides, nulls equal."""
    if known is None or not known.rows:
        return dim_product(seed)
    old = known.df.select("product_key", *[F.col(c).alias(f"k_{c}") for c in NATURAL_KEY],
                          F.col("sub_category").alias("k_sub_category"), F.col("category").alias("k_category"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in NATURAL_KEY])
    new = seed.df.join(bounded_broadcast(old, known.rows), same, "left_anti")
    top = known.df.agg(F.max("product_key")).first()[0]
    place = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER]))  # one task: a catalog
    added = new.select((place + top).cast("int").alias("product_key"), "items", "sub_category", "category", "variation", "size")
    listed = seed.df.select(*NATURAL_KEY, "sub_category", "category", F.lit(True).alias("listed"))
    kept = old.join(bounded_broadcast(listed, seed.rows), same, "left").select(
        "product_key", F.col("k_items").alias("items"),
        *[F.when(F.col("listed"), F.col(c)).otherwise(F.col(f"k_{c}")).alias(c) for c in ("sub_category", "category")],
        F.col("k_variation").alias("variation"), F.col("k_size").alias("size"))
    return Sized(kept.unionByName(added), known.rows + seed.rows)


def dim_date_from_bounds(bounds: DataFrame, holidays: DataFrame | None = None,
                         rules: Sized | None = None) -> DataFrame:
    """MDL2: one row per day between ``bounds.start`` and ``bounds.end`` (a
    one-row DataFrame, so the range can come from data), left-joined to the
    holidays (JN8).  ``holidays`` is a typed seed joined on the date; without
    it the yearly ``rules`` are joined on (month, day)."""
    spine = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("d"))
    d = F.col("d")
    if holidays is not None:
        h = holidays.select(F.col("holiday_date").alias("h_date"), "holiday_name", "holiday_type")
        joined = spine.join(h, d == F.col("h_date"), "left")
        is_holiday = F.col("h_date").isNotNull()
    else:
        r = rules.hinted()
        joined = spine.join(r, (F.month(d) == F.col("rule_month")) & (F.dayofmonth(d) == F.col("rule_day")), "left")
        is_holiday = F.col("rule_month").isNotNull()
    return joined.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        is_holiday.alias("is_holiday"),
        "holiday_name", "holiday_type",
    )


def dim_date(spark: SparkSession, start, end, holidays: DataFrame | None = None) -> DataFrame:
    """MDL2 for fixed bounds (the reference spans two calendar years)."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                   F.lit(end).cast("date").alias("end"))
    return dim_date_from_bounds(bounds, holidays, seeds.holiday_rules(spark))


def dim_date_for(df: DataFrame, ts_col: str = "payment_time", vocab: Vocabulary | None = None) -> DataFrame:
    """MDL2 spanning the dates present in ``df`` (min..max of ``ts_col``), with the
    holidays of ``vocab``'s file (SRC4) or, without one, the yearly rules."""
    spark = df.sparkSession
    day = F.to_date(F.col(ts_col).cast("timestamp_ntz"))
    bounds = df.agg(F.min(day).alias("start"), F.max(day).alias("end"))
    holidays = seeds.read_holidays_seed(spark, vocab.holidays_path) if vocab and vocab.holidays_path else None
    return dim_date_from_bounds(bounds, holidays, seeds.holiday_rules(spark))


@dataclass(frozen=True)
class Dims:
    """The star schema's small dimensions, each with a known row count."""

    product: Sized
    flavor: Sized
    sugar: Sized
    spice: Sized
    payment: Sized
    order: Sized

    @staticmethod
    def build(spark: SparkSession, vocab: Vocabulary | None = None) -> "Dims":
        vocab = vocab or Vocabulary()
        return Dims(
            product=dim_product(seeds.products_seed(spark, vocab)),
            flavor=seeds.dim_flavor(spark),
            sugar=seeds.dim_sugar_levels(spark),
            spice=seeds.dim_spice_level(spark),
            payment=seeds.dim_payment_type(spark),
            order=seeds.dim_order_type(spark),
        )

    @staticmethod
    def stored(spark: SparkSession, tables: dict[str, Table], vocab: Vocabulary | None = None) -> "Dims":
        """SNK8: the dimensions as tables (one for each field), brought up to date and
        read back.  Product keys come from the table's own rows, so a catalog that
        grows shifts none; a table whose content is right is not written again."""
        vocab = vocab or Vocabulary()
        found = {}
        for name, fresh in vars(Dims.build(spark, vocab)).items():
            table = tables[name]
            known = table.exists(spark)
            held = table.read(spark)
            rows = held.count() if known else 0
            if name == "product" and known:
                fresh = register_products(seeds.products_seed(spark, vocab), Sized(held, rows))
            if not known or not fresh.df.exceptAll(held).isEmpty() or (name != "product" and rows != fresh.rows):
                rows = table.replace(spark, fresh.df)
            found[name] = Sized(table.read(spark), rows)
        return Dims(**found)
