"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    extraction,
    jaccard,
    mixing,
    neighbours,
    packing,
    paragraphs,
    quality,
    sharding,
    simhash,
    tokens,
    tries,
    warc,
    whitening,
)
from meterline.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicated_archives(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(_table(spark, sf_dir, "documents")).drop("text_hash")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.judge(docs, labels, ["doc_id"])


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = {"text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary"))}
    docs = _table(spark, sf_dir, "documents")
    return sharding.shard_by_bytes(docs, 24, instead_of_text=crc).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars"
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A first call fills the cache, a second one counts the whole table through it.
    docs, cache = _table(spark, sf_dir, "documents"), shared_folder(spark, "token-cache")
    tokens.fill_cache(docs, cache)
    return tokens.count_tokens(docs, cache).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit"
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tries.paths_of(_table(spark, sf_dir, "conversations"))
    return tries.prefix_trie(tries.with_family_heads(paths))


def op12_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Query]:
    return {
        q.__name__: q
        for q in (
            op1_warc_revisits,
            op2_mixing,
            op3_repeated_paragraphs,
            op4_quality_rules,
            op5_nearest_neighbours,
            op6_packing,
            op7_sharding,
            op8_simhash,
            op9_html_text,
            op10_token_counts,
            op11_conversation_trie,
            op12_shingle_join,
            op13_whitening,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_conversation_trie": tries.ORACLE_SQL}
