"""Table schemas and the select-cast conform step (PRJ9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tillstack import fixed_values as FV

_TYPES = {t.simpleString(): t for t in (BooleanType(), DateType(), DoubleType(), IntegerType(), StringType(), TimestampNTZType())}


def _s(*columns) -> StructType:
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in columns])


# The delivered report is read all-string; these are the normalised names
# the cleaning step uses (columns may be missing: cash, gcash, order_type).
RAW_REPORT_COLUMNS = FV.RAW_REPORT_COLUMNS

STAGING = _s(*FV.STAGING_COLUMNS)
STAGING_FLAGGED = _s(*FV.STAGING_COLUMNS, *FV.FLAG_COLUMNS)
QUARANTINE = _s(*FV.STAGING_COLUMNS, *FV.QUARANTINE_COLUMNS)
PRODUCTS_SEED = _s(*FV.PRODUCTS_SEED_COLUMNS)
HOLIDAYS_SEED = _s(*FV.HOLIDAYS_SEED_COLUMNS)
FACT = _s(*FV.FACT_COLUMNS)
# as stored: with the key of the staging line that a fact line comes from
FACT_LINES = StructType(FACT.fields + [StructField("line_key", LongType(), True)])
UNMAPPED = _s(*FV.UNMAPPED_COLUMNS)
DIMENSIONS = {name: _s(*columns) for name, columns in FV.DIM_COLUMNS.items()}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select-cast ``df`` to ``schema`` in order; absent columns become typed
    nulls and extra columns are dropped (the fixed-schema load)."""
    present = set(df.columns)
    return df.select([
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
