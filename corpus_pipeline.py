"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that its predecessor kept and calls one operator.  All
but the last return the columns of ``documents``: texts that the classifier
rejects go, one document of each near-duplicate group stays, repeated passages
are cut out of the texts, and what is left is packed.  Null and empty texts,
repeated rows and empty tables are handled as the operators' notes say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstack.llm import packing, quality, simhash, substring
from tillstack.llm.common import read_table, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, into="_quality_score")
    return scored.filter(F.col("_quality_score") >= quality.THRESHOLD).drop("_quality_score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate group."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of a smaller id has too; a
    text that loses nothing keeps its white space.  ``n_chars`` follows."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = substring.cut_repeats(docs, carry=others, respace=False)
    named = {"doc_id": F.col("id"), "text": F.col("kept")} | {c: F.col(f"_c{i}") for i, c in enumerate(others)}
    if "n_chars" in named:
        named["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[named[c].alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining texts and their places in sequences."""
    return packing.op8_packing(docs)


STAGES = [("quality_filter", quality_filter), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("best_fit_packing", best_fit_packing)]

#: No stage as a whole can be written in SQL (a trained model, fingerprints by XXH64, a
#: tokenizer's ids); tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each one's result is written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
