"""Good / quarantine split (MDL9: FLT4, FLT5, NUM4, PRJ11, SET2)."""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from tillstack import fixed_values as FV
from tillstack.functions.dates import local_today
from tillstack.functions.numeric import null_false


def bad_mask(df: DataFrame) -> Column:
    """FLT4: the seven OR-ed conditions; null comparisons count as false."""
    items = F.col("items")
    return (
        items.isNull()
        | null_false(items == FV.MISSING_TEXT)
        | F.col("total_order_amount").isNull()
        | F.col("order_id").isNull()
        | null_false(F.col("quantity") <= 0)
        | null_false(F.col("sub_category") == FV.UNCATEGORIZED)
        | null_false(F.col("category") == FV.UNCATEGORIZED)
    )


def quarantine_reason() -> Column:
    """NUM4: one reason per row; later rules override earlier ones, so the
    chain tests them in reverse.  The literal item ``nan`` gets none."""
    return (
        F.when(null_false(F.col("category") == FV.UNCATEGORIZED), F.lit(FV.REASON_UNCAT_CATEGORY))
        .when(null_false(F.col("sub_category") == FV.UNCATEGORIZED), F.lit(FV.REASON_UNCAT_SUB))
        .when(null_false(F.col("quantity") <= 0), F.lit(FV.REASON_BAD_QUANTITY))
        .when(F.col("order_id").isNull(), F.lit(FV.REASON_NULL_ORDER))
        .when(F.col("total_order_amount").isNull(), F.lit(FV.REASON_NULL_AMOUNT))
        .when(F.col("items").isNull(), F.lit(FV.REASON_NULL_ITEM))
    )


def all_reasons() -> Column:
    """Q19 option: every rule a row breaks, not only the winning one."""
    rules = [
        (F.col("items").isNull(), FV.REASON_NULL_ITEM),
        (F.col("total_order_amount").isNull(), FV.REASON_NULL_AMOUNT),
        (F.col("order_id").isNull(), FV.REASON_NULL_ORDER),
        (null_false(F.col("quantity") <= 0), FV.REASON_BAD_QUANTITY),
        (null_false(F.col("sub_category") == FV.UNCATEGORIZED), FV.REASON_UNCAT_SUB),
        (null_false(F.col("category") == FV.UNCATEGORIZED), FV.REASON_UNCAT_CATEGORY),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in rules]), lambda x: x.isNotNull())


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(~bad_mask(df))


def quarantine_rows(df: DataFrame, now_utc: _dt.datetime | None = None,
                    tz: str = FV.QUARANTINE_TIMEZONE, with_all_reasons: bool = False) -> DataFrame:
    cols = {"quarantine_reason": quarantine_reason(), "quarantine_timestamp": local_today(tz, now_utc)}
    if with_all_reasons:
        cols["quarantine_reasons"] = all_reasons()
    return df.filter(bad_mask(df)).withColumns(cols)


def split_good_bad(df: DataFrame, now_utc: _dt.datetime | None = None,
                   persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """FLT5: complementary halves.  With ``persist`` the input is computed
    once (memory, spilling to disk) for both halves."""
    if persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return good_rows(df), quarantine_rows(df, now_utc)
