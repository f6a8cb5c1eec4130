"""Data-quality checks (CHK1-10).

Results are a DataFrame ``(check_name, table_name, column_name, severity,
failures, passed)``.  All row-level checks of one table (not_null,
expression) are counted in **one** aggregate pass, that of the table's first
unique_combination check if it has one; each other grouped check (unique,
unique_combination, accepted_values) is one partial-aggregate shuffle.  ``failures`` counts what the check query returns: failing rows
for row-level checks, failing values or key groups for grouped ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillstack import fixed_values as FV
from tillstack.sources.seeds import BROADCAST_ROW_LIMIT, bounded_broadcast, local_table

ERROR = "error"
WARN = "warn"


class CheckFailed(RuntimeError):
    """An error-severity check failed (the circuit breaker, CHK8)."""


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | unique_combination | expression
    columns: tuple                 # one column, or the combination
    severity: str = ERROR
    values: tuple = ()             # accepted values
    expression: str = ""           # e.g. "!= 0", applied to the column
    store_failures: bool = False

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def name(self, table: str) -> str:
        suffix = {"expression": "_" + _expr_slug(self.expression)}.get(self.kind, "")
        return f"{self.kind}_{table}_{'_'.join(self.columns)}{suffix}"


def _expr_slug(e: str) -> str:
    words = {"!=": "ne", ">=": "ge", "<=": "le", ">": "gt", "<": "lt", "=": "eq", "-": "minus"}
    out = e
    for k, v in words.items():
        out = out.replace(k, f" {v} ")
    return "_".join(out.split())


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def failing_predicate(check: Check) -> Column:
    """Row-level failure predicate (null-safe as the check semantics say)."""
    c = _col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "expression":
        # a null result passes: only a definite false fails
        return ~F.coalesce(F.expr(f"`{check.columns[0]}` {check.expression}"), F.lit(True))
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    raise ValueError(check.kind)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The check's query: failing rows, or failing groups with their count."""
    if check.kind in ("not_null", "expression"):
        return df.filter(failing_predicate(check))
    if check.kind == "accepted_values":
        c = check.columns[0]
        return df.filter(failing_predicate(check)).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
    if check.kind == "unique":
        c = check.columns[0]
        return (df.filter(_col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if check.kind == "unique_combination":
        cols = list(check.columns)
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)
    raise ValueError(check.kind)


def _result_rows(table: str, checks: list[Check], counts: list[Column]) -> list[Column]:
    return [
        F.struct(F.lit(ch.name(table)).alias("check_name"), F.lit(table).alias("table_name"),
                 F.lit(ch.column).alias("column_name"), F.lit(ch.severity).alias("severity"),
                 n.cast("bigint").alias("failures"))
        for ch, n in zip(checks, counts)
    ]


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; returns the results DataFrame."""
    missing = {c for ch in checks for c in ch.columns} - set(df.columns)
    if missing:
        raise ValueError(f"checks on {table} name missing columns: {sorted(missing)}")
    parts = []
    row_level = [ch for ch in checks if ch.kind in ("not_null", "expression")]
    grain = next((ch for ch in checks if ch.kind == "unique_combination"), None)
    if grain and row_level:  # one pass: what the row-level rules count goes along with the groups
        failed = {f"_f{i}": F.count_if(failing_predicate(ch)) for i, ch in enumerate(row_level)}
        groups = df.groupBy(*grain.columns).agg(F.count(F.lit(1)).alias("n_records"), *[n.alias(c) for c, n in failed.items()])
        counts = [F.count_if(F.col("n_records") > 1), *[F.coalesce(F.sum(c), F.lit(0)) for c in failed]]
        parts.append(_result_frame(groups, table, [grain, *row_level], counts))
    elif row_level:
        parts.append(_result_frame(df, table, row_level, [F.count_if(failing_predicate(ch)) for ch in row_level]))
    for ch in checks:
        if ch in row_level or (row_level and ch is grain):
            continue
        n = failing_rows(df, ch).agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.explode(F.array(*_result_rows(table, [ch], [F.col("n")]))).alias("r"))
                     .select("r.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("failures") == 0)


def run_grain_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """``run_checks`` of one unique_combination check and row-level ones on rows whose
    combinations are expected to differ; counts at once.

    Rows are grouped by a hash of the combination, so that 8 bytes a row are shuffled.
    Combinations alone in their hash are unique; the others' rows, duplicates and rows
    of equal hashes, are grouped by the combination itself: few hashes are looked up,
    many make it the plain check."""
    spark, (grain,) = df.sparkSession, [ch for ch in checks if ch.kind == "unique_combination"]
    row_level = [ch for ch in checks if ch is not grain]
    keyed = df.withColumn("_h", F.xxhash64(*[_col(c) for c in grain.columns], *[_col(c).isNull() for c in grain.columns]))
    groups = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("n_records"),
                                     *[F.count_if(failing_predicate(ch)).alias(f"_f{i}") for i, ch in enumerate(row_level)])
    shared = F.col("n_records") > 1
    seen = groups.agg(F.count_if(shared), *[F.coalesce(F.sum(f"_f{i}"), F.lit(0)) for i in range(len(row_level))]).first()
    if seen[0] > BROADCAST_ROW_LIMIT:
        return run_checks(df, table, checks)
    failures = dict(zip(row_level, seen[1:]))
    failures[grain] = 0
    if seen[0]:
        few = bounded_broadcast(groups.filter(shared).select("_h"), seen[0])
        failures[grain] = failing_rows(keyed.join(few, "_h", "left_semi"), grain).count()
    return local_table(spark, [(ch.name(table), table, ch.column, ch.severity, failures[ch], failures[ch] == 0) for ch in (grain, *row_level)],
                       "check_name string, table_name string, column_name string, severity string, failures bigint, passed boolean")


def _result_frame(df: DataFrame, table: str, checks: list[Check], counts: list[Column]) -> DataFrame:
    return df.agg(F.array(*_result_rows(table, checks, counts)).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def enforce(results: DataFrame) -> None:
    """CHK8: raise if an error-severity check failed.  Collects only the
    failing result rows (one per check, bounded by the suite)."""
    bad = results.filter((F.col("severity") == ERROR) & ~F.col("passed")).collect()
    if bad:
        names = ", ".join(f"{r.check_name} ({r.failures})" for r in bad)
        raise CheckFailed(f"error-severity checks failed: {names}")


def stored_failures(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """CHK7: the failing rows of the row-level checks marked ``store_failures``,
    a row for each check it fails (``check_name`` first), in one pass over ``df``."""
    marked = [ch for ch in checks if ch.store_failures]
    if not marked:
        return df.limit(0).select(F.lit("").alias("check_name"), "*")
    failed = F.filter(F.array(*[F.when(failing_predicate(ch), F.lit(ch.name(table))) for ch in marked]), lambda x: x.isNotNull())
    return df.select(F.explode(failed).alias("check_name"), "*")


def store_failures(df: DataFrame, table: str, checks: list[Check], path: str) -> str:
    """SNK13: write ``stored_failures`` under ``path``, a folder for each check."""
    stored_failures(df, table, checks).write.partitionBy("check_name").mode("overwrite").parquet(path)
    return path


# --- suites (column names as they exist in the data) ------------------------

def _nn(*cols, severity=ERROR):
    return [Check("not_null", (c,), severity) for c in cols]


FACT_CHECKS = (
    [Check("unique_combination", tuple(FV.FACT_GRAIN))]
    + _nn("payment_time", "date_key", "product_key")
    + [Check("expression", ("product_key",), WARN, expression="!= -1")]
    + _nn("flavor_key", "sugar_key", "spice_key", "payment_type_key")
    + [Check("expression", ("payment_type_key",), ERROR, expression="!= 0", store_failures=True)]
    + _nn("order_type_key")
    + [Check("expression", ("order_type_key",), ERROR, expression="!= 0", store_failures=True)]
    + _nn("order_id", "category", "sub_category", "quantity")
    + [Check("expression", ("quantity",), ERROR, expression="> 0", store_failures=True)]
    + _nn("total_order_amount")
    + [Check("expression", ("total_order_amount",), ERROR, expression="> 0", store_failures=True)]
    + _nn("received_amount")
    + [Check("expression", ("received_amount",), ERROR, expression=">= 0", store_failures=True)]
)

STAGING_CHECKS = [Check("unique_combination", tuple(FV.MERGE_KEYS)), Check("not_null", ("order_id",))]
QUARANTINE_CHECKS = list(STAGING_CHECKS)

DIM_CHECKS = {
    "dim_product": [Check("unique", ("product_key",)), Check("not_null", ("product_key",)),
                    Check("not_null", ("category",)),
                    Check("accepted_values", ("category",), values=tuple(FV.ACCEPTED_CATEGORIES)),
                    Check("not_null", ("items",))],
    "dim_date": [Check("unique", ("date_key",)), Check("not_null", ("date_key",)),
                 Check("accepted_values", ("day_of_week",), values=tuple(FV.ACCEPTED_WEEKDAYS)),
                 Check("not_null", ("is_weekend",))],
    "dim_flavor": [Check("unique", ("flavor_key",)), Check("not_null", ("flavor_key",)),
                   Check("not_null", ("flavor_name",)),
                   Check("accepted_values", ("flavor_name",), values=tuple(FV.ACCEPTED_FLAVORS))],
    "dim_spice_level": [Check("unique", ("spice_key",)), Check("not_null", ("spice_key",)),
                        Check("not_null", ("spice_level",)),
                        Check("accepted_values", ("spice_level",), values=tuple(FV.ACCEPTED_SPICE))],
    "dim_sugar_levels": [Check("unique", ("sugar_key",)), Check("not_null", ("sugar_key",)),
                         Check("not_null", ("sugar_level",))],
    "dim_payment_type": [Check("unique", ("payment_type_key",)), Check("not_null", ("payment_type_key",)),
                         Check("not_null", ("payment_type",))],
    "dim_order_type": [Check("unique", ("order_type_key",)), Check("not_null", ("order_type_key",)),
                       Check("not_null", ("order_type",))],
}


def check_suite(tables: dict[str, tuple[DataFrame, list[Check]]]) -> DataFrame:
    """CHK10: results of several tables' checks in one DataFrame."""
    return reduce(DataFrame.unionByName, [run_checks(df, t, cs) for t, (df, cs) in tables.items()])
