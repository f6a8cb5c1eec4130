"""The queries of this package's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstack.llm import bpe, fixity, lexical, licenses, minhash, packing, quality, runs, simhash, substring, template, topk, winnow
from tillstack.llm.common import read_table


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op2_simhash(read_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op3_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.op5_substring(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8_packing(read_table(spark, sf_dir, "documents"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.op10_winnowing(read_table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op6_topk(read_table(spark, sf_dir, "embeddings"))


def op4_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.op4_template(read_table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op7_bpe(read_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op9_licenses(read_table(spark, sf_dir, "documents"))


def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.op1_fixity(read_table(spark, sf_dir, "pages"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.op11_lexical(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.op12_minhash(read_table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.op13_runs(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fixity, op2_simhash, op3_quality, op4_template, op5_substring, op6_topk, op7_bpe, op8_packing, op9_licenses,
                                   op10_winnowing, op11_lexical, op12_minhash, op13_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op1_fixity": fixity.SQL, "op6_topk": topk.SQL, "op9_licenses": licenses.oracle_sql(), "op11_lexical": lexical.SQL,
            "op12_minhash": minhash.SQL}
