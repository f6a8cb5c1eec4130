"""Seeds, literal relations and lookup tables (SRC4, SRC5, SRC8, SRC10).

Lookups and literal dimensions are built on the driver from small Python
collections, so their row count is known exactly before anything runs;
``bounded_broadcast`` only hints a broadcast when that count is under a
limit, and otherwise leaves the join strategy to AQE's runtime sizes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillstack import catalog as CAT
from tillstack import fixed_values as FV
from tillstack.functions.text import TextRules
from tillstack.schemas import HOLIDAYS_SEED, PRODUCTS_SEED

# Lookups above this many rows are not broadcast by hint.
BROADCAST_ROW_LIMIT = 200_000


def local_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal relation planned as a driver-side ``LocalRelation``
    (a parameterised ``VALUES``), so joining or broadcasting it runs no job
    and its size is known to the planner.  ``schema`` is a StructType or DDL."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = schema.fields
    if not rows:
        return spark.createDataFrame([], schema)
    args, tuples = {}, []
    for i, row in enumerate(rows):
        marks = []
        for j, (v, f) in enumerate(zip(row, fields)):
            key = f"v{i}_{j}"
            args[key] = v
            marks.append(f"CAST(:{key} AS {f.dataType.simpleString()})")
        tuples.append("(" + ", ".join(marks) + ")")
    names = ", ".join(f"`{f.name}`" for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS t({names})", args=args)


def bounded_broadcast(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its row count is known and small."""
    if rows is not None and rows <= limit:
        return F.broadcast(df)
    return df


@dataclass(frozen=True)
class Vocabulary:
    """User-editable maps, catalog and text rules (UDF3).  Defaults are our own
    menu; ``catalog_path`` / ``holidays_path`` read the seeds from files (SRC4-5)."""

    product_to_sub: dict = field(default_factory=lambda: dict(CAT.PRODUCT_TO_SUB))
    sub_to_category: dict = field(default_factory=lambda: dict(CAT.SUB_TO_CATEGORY))
    corrections: dict = field(default_factory=lambda: dict(CAT.CORRECTIONS))
    catalog: list = field(default_factory=lambda: list(CAT.CATALOG))
    rules: TextRules = field(default_factory=TextRules)
    catalog_path: str | None = None
    holidays_path: str | None = None


@dataclass(frozen=True)
class Sized:
    """A relation together with its exact row count."""

    df: DataFrame
    rows: int

    def hinted(self) -> DataFrame:
        return bounded_broadcast(self.df, self.rows)


def category_lookup(spark: SparkSession, vocab: Vocabulary) -> Sized:
    """NUM5 as one relation: item → (sub_category, category).  The two maps
    are composed on the driver, so the pipeline needs one join, not two."""
    rows = [(item, sub, vocab.sub_to_category.get(sub)) for item, sub in vocab.product_to_sub.items()]
    schema = "lookup_item string, lookup_sub_category string, lookup_category string"
    return Sized(local_table(spark, rows, schema), len(rows))


def corrections_lookup(spark: SparkSession, vocab: Vocabulary) -> Sized:
    rows = list(vocab.corrections.items())
    return Sized(local_table(spark, rows, "fix_from string, fix_to string"), len(rows))


def products_seed(spark: SparkSession, vocab: Vocabulary) -> Sized:
    if vocab.catalog_path:
        df = read_products_seed(spark, vocab.catalog_path)
        return Sized(df, df.count())
    return Sized(local_table(spark, vocab.catalog, PRODUCTS_SEED), len(vocab.catalog))


def read_products_seed(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: typed catalog CSV; blank cells become null."""
    return spark.read.schema(PRODUCTS_SEED).option("header", True).option("nullValue", "").csv(path)


def read_holidays_seed(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: typed holiday CSV."""
    return spark.read.schema(HOLIDAYS_SEED).option("header", True).csv(path)


def holiday_rules(spark: SparkSession) -> Sized:
    rows = CAT.HOLIDAY_RULES
    schema = "rule_month int, rule_day int, holiday_name string, holiday_type string"
    return Sized(local_table(spark, rows, schema), len(rows))


def _literal(spark: SparkSession, rows, fields) -> Sized:
    schema = StructType([StructField(n, t, True) for n, t in fields])
    return Sized(local_table(spark, rows, schema), len(rows))


# SRC8 / SET1: the five literal dimensions.
def dim_flavor(spark: SparkSession) -> Sized:
    return _literal(spark, FV.DIM_FLAVOR_ROWS, [("flavor_key", IntegerType()), ("flavor_name", StringType())])


def dim_sugar_levels(spark: SparkSession) -> Sized:
    return _literal(spark, FV.DIM_SUGAR_ROWS, [
        ("sugar_key", IntegerType()), ("sugar_level", StringType()), ("percentage", IntegerType())])


def dim_spice_level(spark: SparkSession) -> Sized:
    return _literal(spark, FV.DIM_SPICE_ROWS, [
        ("spice_key", IntegerType()), ("spice_level", StringType()), ("intensity", IntegerType())])


def dim_payment_type(spark: SparkSession) -> Sized:
    return _literal(spark, FV.DIM_PAYMENT_ROWS, [("payment_type_key", IntegerType()), ("payment_type", StringType())])


def dim_order_type(spark: SparkSession) -> Sized:
    return _literal(spark, FV.DIM_ORDER_ROWS, [("order_type_key", IntegerType()), ("order_type", StringType())])
