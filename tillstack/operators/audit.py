"""Unmapped-rows audit (UPS4: FLT8, JN9, FLT9, PRJ10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstack.operators.dims import Dims
from tillstack.operators.fact import high_water_filter


def unmapped_rows(staging: DataFrame, dims: Dims, existing: DataFrame | None = None) -> DataFrame:
    """Staging rows missing a payment type, product or order type.

    The product join matches on ``items`` only, exactly as written, so an
    item with several catalog variants yields one row per variant when
    another dimension is missing (the reference's fan-out, bounded by the
    catalog).  The incremental filter compares the raw text times.
    """
    s = high_water_filter(staging, existing, use_flag=False, cast_ts=False)
    if existing is not None and "sale_date" in staging.columns:
        # text order is time order for parsed times: older day partitions hold nothing after the mark
        mark = existing.select(F.max("payment_time").alias("t")).first().t
        day = F.to_date(F.lit(mark).try_cast("timestamp_ntz"))
        if mark is not None and staging.sparkSession.range(1).select(day.alias("d")).first().d is not None:
            s = s.filter(F.col("sale_date").isNull() | (F.col("sale_date") >= day))
    pay = dims.payment.hinted().select("payment_type_key", F.col("payment_type").alias("d_payment"))
    prod = dims.product.hinted().select("product_key", F.col("items").alias("d_items"))
    order = dims.order.hinted().select("order_type_key", F.col("order_type").alias("d_order"))
    j = (s.join(pay, F.col("payment_type") == F.col("d_payment"), "left")
         .join(prod, F.col("items") == F.col("d_items"), "left")
         .join(order, F.col("order_type") == F.col("d_order"), "left"))
    return j.filter(
        F.col("payment_type_key").isNull() | F.col("product_key").isNull() | F.col("order_type_key").isNull()
    ).select("order_id", "payment_time", "total_order_amount", "received_amount",
             "payment_type", "items", "order_type")
