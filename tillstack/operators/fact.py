"""Incremental fact load (UPS3: FLT6, FLT7, JN1-7, PRJ5-8).

Plan shape: one scan of staging → the high-water-mark filter (a scalar
subquery on the existing fact, evaluated once) → six broadcast hash joins
against dimensions whose row counts are known → projection.  No shuffle
until the writer's ``repartition(sale_date)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstack import fixed_values as FV
from tillstack.functions.dates import date_key, to_naive_ts
from tillstack.functions.numeric import null_false
from tillstack.functions.text import blank_key, match_key
from tillstack.operators.dims import Dims
from tillstack.sources.sinks import day_of, in_days


def high_water_filter(staging: DataFrame, existing: DataFrame | None, ts_col: str = "payment_time",
                      use_flag: bool = True, cast_ts: bool = True) -> DataFrame:
    """FLT6/FLT7/FLT8: rows strictly after the target's max time, or flagged
    for reprocessing.  No target, or an empty one, is a first (full) run."""
    if existing is None:
        return staging
    hwm = existing.select(F.max(ts_col)).scalar()
    ts = to_naive_ts(ts_col) if cast_ts else F.col(ts_col)
    cond = hwm.isNull() | null_false(ts > hwm)
    if use_flag and "is_reprocessed" in staging.columns:
        cond = cond | null_false(F.col("is_reprocessed"))
    return staging.filter(cond)


KEYS = ["product_key", "flavor_key", "sugar_key", "spice_key", "payment_type_key", "order_type_key"]
#: What tells one fact line from another, nulls equal.  The resolved keys do not: all
#: unknown items of an order share one product key.
LINE = ["order_id", "line_key"]


def line_key() -> Column:
    """A staging line's key: a hash of its merge keys, by which staging is unique."""
    return F.xxhash64(*FV.MERGE_KEYS, *[F.col(c).isNull() for c in FV.MERGE_KEYS])


def same_line(left: DataFrame, right: DataFrame) -> tuple[DataFrame, Column]:
    """The different lines of ``right`` under other names, and the condition that a row
    of ``left`` is one of them."""
    lines = right.select(*[F.col(c).alias(f"_l_{c}") for c in LINE]).distinct()
    return lines, reduce(lambda a, b: a & b, [left[c].eqNullSafe(lines[f"_l_{c}"]) for c in LINE])


def mark_rows(rows: DataFrame, sets: list[DataFrame], keys, place) -> DataFrame:
    """``rows`` with ``_hit``: whether each of ``sets`` holds a row of the same ``keys``
    (nulls equal).  ``place`` puts them all where ``rows`` are to be written, and names the
    columns, made from the keys, that it goes by: the rows are shuffled once for both."""
    others = [c for c in rows.columns if c not in keys]
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in others]
    parts = [rows.select(*keys, F.lit(0).alias("_set"), *others),
             *[s.select(*keys, F.lit(i).alias("_set"), *nothing) for i, s in enumerate(sets, 1)]]
    both, by = place(reduce(DataFrame.unionByName, parts))
    alike = Window.partitionBy(*dict.fromkeys([*by, *keys]))
    hit = reduce(lambda a, b: a & b, [F.max(F.col("_set") == i).over(alike) for i in range(1, len(sets) + 1)])
    return both.withColumn("_hit", hit).filter(F.col("_set") == 0).select(*rows.columns, "_hit")


#: The keys of ``mark_rows`` for lines of day-partitioned tables: a line has one day.
DAY_LINE = [*LINE, "sale_date"]


def resolve_keys(raw: DataFrame, dims: Dims, dim_date: DataFrame | None = None) -> DataFrame:
    """JN1-JN7 as broadcast left joins: ``raw`` with ``ts``, ``k_date`` and the six
    keys; unmatched product → −1, others → 0."""
    dp = dims.product.hinted().select(
        F.col("product_key"),
        match_key("items").alias("dp_items"),
        blank_key("variation").alias("dp_variation"),
        blank_key("size").alias("dp_size"),
    )
    f = raw.select(
        "*",
        match_key("items").alias("k_items"),
        blank_key("variation").alias("k_variation"),
        blank_key("size").alias("k_size"),
        to_naive_ts("payment_time").alias("ts"),
    ).withColumn("k_date", date_key(F.to_date("ts")))
    f = f.join(dp,
               (F.col("k_items") == F.col("dp_items"))
               & (F.col("k_variation") == F.col("dp_variation"))
               & (F.col("k_size") == F.col("dp_size")), "left")
    if dim_date is not None:
        # JN2 uses no column; with a provably unique right side Catalyst
        # removes the join entirely.
        dd = dim_date.select(F.col("date_key").alias("dd_date_key")).dropDuplicates()
        f = f.join(dd, F.col("k_date") == F.col("dd_date_key"), "left")
    fl = dims.flavor.hinted().select("flavor_key", F.col("flavor_name").alias("d_flavor"))
    su = dims.sugar.hinted().select("sugar_key", F.col("sugar_level").alias("d_sugar"))
    sp = dims.spice.hinted().select("spice_key", F.col("spice_level").alias("d_spice"))
    pt = dims.payment.hinted().select("payment_type_key", F.col("payment_type").alias("d_payment"))
    ot = dims.order.hinted().select("order_type_key", F.col("order_type").alias("d_order"))
    f = (f.join(fl, F.coalesce("flavor", F.lit(FV.NO_FLAVOR)) == F.col("d_flavor"), "left")
         .join(su, F.coalesce("sugar_level", F.lit(FV.NO_SUGAR)) == F.col("d_sugar"), "left")
         .join(sp, F.coalesce("spice_level", F.lit(FV.NO_SPICE)) == F.col("d_spice"), "left")
         .join(pt, F.col("payment_type") == F.col("d_payment"), "left")
         .join(ot, F.col("order_type") == F.col("d_order"), "left"))
    unknown = {"product_key": FV.UNKNOWN_PRODUCT_KEY}
    keys = [F.coalesce(k, F.lit(unknown.get(k, FV.UNKNOWN_MEMBER_KEY))).cast("int").alias(k) for k in KEYS]
    return f.select(*[F.col(f"`{c}`") for c in raw.columns], "ts", "k_date", *keys)


def join_dimensions(raw: DataFrame, dims: Dims, dim_date: DataFrame | None = None) -> DataFrame:
    """The fact rows (PRJ5-8) of staging rows, with their line's key."""
    return resolve_keys(raw.withColumn("line_key", line_key()), dims, dim_date).select(
        F.col("ts").alias("payment_time"), F.col("k_date").alias("date_key"), *KEYS,
        "order_id", "category", "sub_category", "quantity", "total_order_amount", "received_amount", "line_key")


def build_fact(staging: DataFrame, dims: Dims, existing: DataFrame | None = None,
               use_flag: bool = True, dim_date: DataFrame | None = None) -> DataFrame:
    """UPS3: the fact rows to append (all of them on a first run)."""
    return join_dimensions(high_water_filter(staging, existing, use_flag=use_flag), dims, dim_date)


def high_water_mark(fact: DataFrame):
    """The last time in a day-partitioned fact and its day, or None: the newest day
    partition alone is read."""
    day = fact.select(F.max("sale_date").alias("d")).first().d  # partition values, no file
    if day is None:
        return None
    return fact.filter(F.col("sale_date") == F.lit(day)).agg(F.max("payment_time").alias("t")).first().t, day


def fact_increment(staging: DataFrame, dims: Dims, existing: DataFrame, held=None, placing=None) -> DataFrame:
    """UPS3 on day-partitioned tables: the rows to append to ``existing``.

    New rows are read from the mark's day partition of staging on; rows flagged for
    reprocessing come from all days (a pushed-down filter), minus the lines that the
    fact has already, so a run that stopped before the flags were reset appends
    nothing twice.

    ``placing`` (with ``held``, the days that ``existing`` has) makes of the flagged rows
    a day the ``place`` of ``mark_rows``: a day's rows are in few tasks then, to be written
    there.  Those of days that the fact does not hold are where their files put them.
    """
    at = high_water_mark(existing)
    if at is None:
        return join_dimensions(staging, dims)
    mark, day = at
    flagged = F.coalesce(F.col("is_reprocessed"), F.lit(False))
    recent = join_dimensions(staging.filter((F.col("sale_date") >= F.lit(day)) & ~flagged & (to_naive_ts("payment_time") > F.lit(mark).cast("timestamp_ntz"))), dims)
    again = staging.filter(F.col("is_reprocessed"))
    # only the flagged rows' days of the fact are read (a row a day)
    rows = {r.sale_date: r.n for r in again.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return recent
    if placing is None:
        again = join_dimensions(again, dims)
        lines, same = same_line(again, existing.filter(in_days(rows)))
        return recent.unionByName(again.join(lines, same, "left_anti"))
    parts, old = [recent], {d: n for d, n in rows.items() if d in held}
    if len(old) < len(rows):
        parts.append(join_dimensions(again.filter(in_days(d for d in rows if d not in old)), dims))
    if old:
        here = in_days(old)
        lines = join_dimensions(again.filter(here), dims).withColumn("sale_date", day_of())
        marked = mark_rows(lines, [existing.filter(here)], DAY_LINE, placing(old))
        parts.append(marked.filter(~F.col("_hit")).drop("_hit", "sale_date"))
    return reduce(DataFrame.unionByName, parts)


def with_sale_date(fact: DataFrame) -> DataFrame:
    """SNK10 partition column: the day of ``payment_time``."""
    return fact.withColumn("sale_date", F.to_date("payment_time"))
