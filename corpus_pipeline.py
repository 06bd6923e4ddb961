"""The corpus pipeline: from raw documents to packed training sequences in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import mixing, packing, paragraphs, quality, simhash
from meterline.plans.shared import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*rest).alias("row"))
    kept = quality.judge(rows, labels, ["row", "text"]).where("kept")
    return kept.select(*[F.col(c if c == "text" else f"row.`{c}`") for c in docs.columns])


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash near copies (three words, two bits), as it is."""
    return simhash.one_per_group(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the paragraphs that an earlier document holds."""
    return paragraphs.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per copy of a document or part of one."""
    used = ["doc_id", "text", "source"]
    rest = [c for c in docs.columns if c not in used]
    rows = docs.select(*used, F.struct(F.lit(0).alias("_"), *rest).alias("row"))
    taken = mixing.mixed_texts(mixing.mix(rows))
    own = {c: F.col(c) for c in used} | {"n_chars": F.length("text").cast("long")}
    return taken.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near copies", near_copy_stage),
    ("repeated passages", passage_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Likelihood ratios, fingerprints and tokenizers have no DuckDB counterpart; tests/llm holds the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what one stage keeps is written for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i + 1}")
    return docs
