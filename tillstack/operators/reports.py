"""Sales reports over the star schema (RPT1-6).

``total_order_amount`` is the order's amount repeated on every item line,
so a plain sum over lines counts an order once per item.  Every report
first reduces lines to orders (``max`` of the amount per order) — a
partial aggregate keyed by order — and aggregates orders from there.
Category and product revenue share an order's amount over its lines by
quantity; the per-order total is a window over the already-reduced
(order × category) rows, whose groups are bounded by the menu size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillstack.operators.dims import Dims


def _r2(c):
    return F.round(c, 2)


def order_level(fact: DataFrame, *keys: str) -> DataFrame:
    """One row per (order, payment time, keys): amount, items, lines."""
    return fact.groupBy("order_id", "payment_time", *keys).agg(
        F.max("total_order_amount").alias("order_amount"),
        F.sum("quantity").alias("items_sold"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("total_order_amount").alias("line_amount"),
    )


def _order_measures(df: DataFrame):
    return [
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("items_sold").alias("items_sold"),
        _r2(F.sum("order_amount")).alias("revenue"),
        _r2(F.sum("line_amount")).alias("naive_line_revenue"),
    ]


def daily_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """RPT1: per day, with calendar attributes from dim_date."""
    per_day = order_level(fact, "date_key").groupBy("date_key").agg(*_order_measures(fact))
    cal = dim_date.select("date_key", "full_date", "day_of_week", "is_weekend", "is_holiday")
    return per_day.join(cal, "date_key", "left")


def monthly_sales(fact: DataFrame) -> DataFrame:
    """RPT2: per calendar month."""
    o = order_level(fact, "date_key").withColumns({
        "year": (F.col("date_key") / 10000).cast("int"),
        "month": ((F.col("date_key") / 100).cast("int") % 100).cast("int"),
    })
    return (o.groupBy("year", "month").agg(*_order_measures(o))
            .withColumn("month_name", F.date_format(F.make_date("year", "month", F.lit(1)), "MMMM")))


def _shared_revenue(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Per (order, keys): quantity, and the order amount shared by quantity."""
    per = fact.groupBy("order_id", "payment_time", *keys).agg(
        F.sum("quantity").alias("qty"),
        F.max("total_order_amount").alias("order_amount"),
        F.count(F.lit(1)).alias("lines"),
    )
    w = Window.partitionBy("order_id", "payment_time")
    order_qty = F.sum("qty").over(w)
    return per.withColumn("share", F.when(order_qty > 0, F.col("order_amount") * F.col("qty") / order_qty))


def category_revenue(fact: DataFrame) -> DataFrame:
    """RPT3: per category and sub-category."""
    s = _shared_revenue(fact, ["category", "sub_category"])
    return s.groupBy("category", "sub_category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("qty").alias("items_sold"),
        _r2(F.sum("share")).alias("revenue"),
    )


def category_totals(fact: DataFrame) -> DataFrame:
    """RPT3 with totals: per sub-category (level 0), per category (1) and over all (3),
    in one aggregate over grouping sets; ``level`` tells a total from a null name."""
    s = _shared_revenue(fact, ["category", "sub_category"])
    return s.rollup("category", "sub_category").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("qty").alias("items_sold"),
        _r2(F.sum("share")).alias("revenue"),
    )


def _distribution(fact: DataFrame, key: str, dim: DataFrame, label: str) -> DataFrame:
    per = order_level(fact, key).groupBy(key).agg(
        F.count(F.lit(1)).alias("orders"),
        _r2(F.sum("order_amount")).alias("revenue"),
    )
    # The grand total is a window over the few per-key rows, not over orders.
    total = F.sum("revenue").over(Window.partitionBy())
    out = per.join(dim.select(key, label), key, "left")
    return out.withColumn("revenue_share", F.round(F.col("revenue") / total, 4))


def payment_distribution(fact: DataFrame, dims: Dims) -> DataFrame:
    """RPT4."""
    return _distribution(fact, "payment_type_key", dims.payment.hinted(), "payment_type")


def order_type_distribution(fact: DataFrame, dims: Dims) -> DataFrame:
    """RPT5."""
    return _distribution(fact, "order_type_key", dims.order.hinted(), "order_type")


def product_performance(fact: DataFrame, dims: Dims) -> DataFrame:
    """RPT6: per product (−1 = not in the catalog), ranked by revenue."""
    s = _shared_revenue(fact, ["product_key"])
    per = s.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("qty").alias("items_sold"),
        _r2(F.sum("share")).alias("revenue"),
    )
    prod = dims.product.hinted().select("product_key", "items", "variation", "size")
    ranked = per.join(prod, "product_key", "left").withColumn(
        "revenue_rank",
        F.rank().over(Window.orderBy(F.col("revenue").desc(), F.col("product_key"))).cast("int"),
    )
    return ranked.orderBy("revenue_rank")
