"""Idempotent merge and recovery (UPS1-2, JN10, REC1-5).

The reference only names these procedures; the contracts below are ours.
Built-in Parquet tables have no MERGE/UPDATE/DELETE, so every operator
returns the rows to append, or the next version of a table, and the
caller writes it to a new directory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillstack import fixed_values as FV
from tillstack.operators.fact import DAY_LINE, line_key, mark_rows, same_line
from tillstack.operators.quarantine import good_rows
from tillstack.schemas import STAGING, STAGING_FLAGGED, conform


def null_safe_match(left: DataFrame, right: DataFrame, keys, prefix: str = "_t_") -> tuple[DataFrame, Column]:
    """Rename ``right``'s keys and build ``AND left.k <=> right.k``.  Spark
    plans ``<=>`` keys as ordinary hash-join keys."""
    r = right.select(*[F.col(k).alias(prefix + k) for k in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[prefix + k]) for k in keys])
    return r, cond


def insert_if_absent(target: DataFrame, batch: DataFrame, keys=FV.MERGE_KEYS, place=None) -> DataFrame:
    """JN10: one batch row for each key (nulls equal) that the target does not hold; among
    copies the smallest by the other columns wins, so the result does not depend on
    partitioning.  One partial aggregate over the target's keys and the batch, safe for a
    hot key: the batch is shuffled once.  ``place`` puts the rows where they are to be
    written beforehand, and names the columns, made from the keys, that it goes by: the
    aggregate then needs no shuffle of its own."""
    others = [c for c in batch.columns if c not in keys]
    fields = {f.name: f.dataType for f in batch.schema}
    held = target.select(*keys, F.lit(True).alias("_held"), *[F.lit(None).cast(fields[c]).alias(c) for c in others])
    rows = held.unionByName(batch.select(*keys, F.lit(False).alias("_held"), *others))
    rows, by = place(rows) if place else (rows, [])
    return (rows.groupBy(*by, *keys).agg(F.max("_held").alias("_held"), F.min(F.struct("_held", *others)).alias("_r"))
            .filter(~F.col("_held")).select(*[F.col(f"_r.{c}" if c in others else c).alias(c) for c in batch.columns]))


def merge_insert(target: DataFrame, batch: DataFrame, keys=FV.MERGE_KEYS,
                 reprocessed: bool | Column | None = False, place=None) -> DataFrame:
    """UPS1/UPS2: the rows a MERGE would insert.  Running it again with the
    same batch after appending them inserts nothing.  ``reprocessed`` sets
    the staging flag (None = the table has no flag, e.g. quarantine); ``place``: see
    ``insert_if_absent``."""
    new = insert_if_absent(target, batch, keys, place)
    if reprocessed is not None:
        new = conform(new, STAGING).withColumn("is_reprocessed", reprocessed if isinstance(reprocessed, Column) else F.lit(reprocessed))
    return new


def with_flag(staging: DataFrame, value: bool = False) -> DataFrame:
    if "is_reprocessed" in staging.columns:
        return staging
    return conform(staging, STAGING).withColumn("is_reprocessed", F.lit(value))


def load_fixed(staging: DataFrame, edited_quarantine: DataFrame, keys=FV.MERGE_KEYS) -> DataFrame:
    """REC1: edited quarantine rows that now pass the checks, flagged for
    reprocessing, minus those already in staging."""
    passing = good_rows(edited_quarantine)
    return merge_insert(staging, conform(passing, STAGING), keys, reprocessed=True)


def delete_fixed(quarantine: DataFrame, staged: DataFrame, keys=FV.MERGE_KEYS, fixed: DataFrame | None = None, place=None) -> DataFrame:
    """REC2: the quarantine table without the rows whose key is among ``staged``, and
    among ``fixed`` if these are given.  ``place``: see ``mark_rows``."""
    if place:
        sets = [staged] if fixed is None else [staged, fixed]
        return mark_rows(quarantine, sets, keys, place).filter(~F.col("_hit")).drop("_hit")
    if fixed is not None:
        r, cond = null_safe_match(fixed, staged, keys)
        staged = fixed.join(r, cond, "left_semi")
    r, cond = null_safe_match(quarantine, staged, keys)
    return quarantine.join(r, cond, "left_anti")


def _matched(staging: DataFrame, fact: DataFrame, place=None) -> DataFrame:
    """``staging`` with ``_l_hit``: whether the row is one of the lines of ``fact``.
    ``place``: see ``mark_rows``; both have their day then."""
    keyed = staging.withColumn("line_key", line_key())
    if place:
        return mark_rows(keyed, [fact], DAY_LINE, place).withColumnRenamed("_hit", "_l_hit")
    lines, same = same_line(keyed, fact)
    hit = keyed.join(lines.withColumn("_l_hit", F.lit(True)), same, "left")
    return hit.withColumn("_l_hit", F.coalesce("_l_hit", F.lit(False)))


def reset_flag(staging: DataFrame, fact: DataFrame, place=None) -> DataFrame:
    """REC3: clear ``is_reprocessed`` on rows whose line is in the fact.  ``place``: see ``mark_rows``."""
    return _matched(staging, fact, place).withColumn(
        "is_reprocessed", F.when(F.col("_l_hit"), F.lit(False)).otherwise(F.col("is_reprocessed"))).select(*staging.columns)


def remove_failed(fact: DataFrame, failures: DataFrame, place=None) -> DataFrame:
    """Drop the failing lines before they are re-fed (the fact load only appends).
    ``place``: see ``mark_rows``."""
    if place:
        return mark_rows(fact, [failures], DAY_LINE, place).filter(~F.col("_hit")).drop("_hit")
    lines, same = same_line(fact, failures)
    return fact.join(lines, same, "left_anti")


def recover(staging: DataFrame, failures: DataFrame, column: str, value, place=None) -> DataFrame:
    """REC4/REC5: set ``column`` to ``value`` on the staging rows of the lines in
    ``failures`` (fact rows of a failed check) and flag them; other lines of the
    same order stay as they are.  ``place``: see ``mark_rows``."""
    staging = with_flag(staging)
    dtype = STAGING_FLAGGED[column].dataType
    j = _matched(staging, failures, place)
    return j.withColumns({
        column: F.when(F.col("_l_hit"), F.lit(value).cast(dtype)).otherwise(F.col(column)),
        "is_reprocessed": F.col("_l_hit") | F.coalesce("is_reprocessed", F.lit(False)),
    }).select(*staging.columns)


def recover_int(staging: DataFrame, failures: DataFrame, column: str, value: int) -> DataFrame:
    return recover(staging, failures, column, int(value))


def recover_str(staging: DataFrame, failures: DataFrame, column: str, value: str) -> DataFrame:
    return recover(staging, failures, column, str(value))
