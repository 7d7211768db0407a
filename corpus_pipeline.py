"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir), calls one operator of
:mod:`rankloom.llm` and returns a frame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import packing, quality_rules, simhash_cover, spaced_seeds, suffix_dedup
from rankloom.llm._work import Workspace, table


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules reject go; kept texts lose their boilerplate lines."""
    return recounted(quality_rules.apply_rules(docs, low_docs=quality_rules.LOW_DOCS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (4-word shingles, 4 bits)."""
    return simhash_cover.keep_one(docs, shingle=4, radius=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occurred before go; the first copy stays."""
    return recounted(suffix_dedup.remove_repeats(docs, length=200, keep="first"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return spaced_seeds.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their training sequence and place in it."""
    return packing.pack_documents(docs, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_poor),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

# Byte-exact hashing, suffix order and a tokenizer have no SQL form: the tests run a plain Python
# version of every stage beside it and compare documents and texts (tests/llm/test_by_hand.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = work.save(stage(spark, docs, sf_dir), f"{i}-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
