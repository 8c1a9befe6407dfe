"""A corpus pipeline over ``documents``: quality rules, exact dedup, near dedup, secret scans, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortspark.llm import exact, fingerprints, packing, quality, secrets
from cohortspark.llm.common import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and whose lines are mostly content."""
    field = quality.train_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, field)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints."""
    return fingerprints.drop_near_duplicates(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced in the text; ``n_chars`` still tells the length as it came."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("secret scans", redact),
    ("packing", pack),
]

#: SQL has neither the field, the fingerprints nor the packing; tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; each stage is stored as a table of the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        scratch = Scratch(spark)
        docs = scratch.table(stage(spark, docs, sf_dir))
        if before:
            before.__exit__()  # the stage is written, so nothing reads the one before it again
        before = scratch
    return docs
