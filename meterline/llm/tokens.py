"""Token counts through a cache keyed by content and tokenizer digests.

The cache is a folder of parquet files (content_digest, tokenizer_digest, n_tokens). Only contents
that it lacks are encoded, each once, and appended; every document then reads its count from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import settle, slices
from meterline.llm.vocab import encoder, public_path
from meterline.plans.sizing import broadcast_when_small

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def squeezed(text: Column) -> Column:
    """Runs of ASCII white space as one space, none at the ends: for tokenizers that drop it."""
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def count_tokens(
    docs: DataFrame,
    cache: str,
    *,
    tokenizer: str = "word_bpe_49k.json",
    normalise: Callable[[Column], Column] = squeezed,
    limit: int = 2048,
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` to documents.

    Input: ``doc_id``, ``text`` and any other columns; columns of the added names are replaced.
    ``cache`` is a folder that driver and executors share; it is made if absent and appended to.
    ``normalise`` must keep the tokenizer's count, as ``squeezed`` does for one that drops white
    space; use the identity for others. Texts are whole, special strings count as the tokenizer
    counts them, and no begin or end token is added.

    A null text counts as an empty one: 0 tokens. Repeated texts, the hot ones too, are encoded
    once: a task passes on one row of each content. Null and repeated ``doc_id`` values are rows
    like others. An empty table gives an empty one and leaves the cache as it is.
    """
    fill_cache(docs, cache, tokenizer=tokenizer, normalise=normalise)
    text = F.coalesce("text", F.lit(""))
    content = F.unhex(F.sha2(normalise(text), 256))
    counts = _read(docs.sparkSession, cache, tokenizer_digest(public_path(tokenizer)))
    keyed = docs.drop("n_bytes", "n_tokens", "over_limit").withColumns(
        {"__digest": content, "n_bytes": F.octet_length(text).cast("long")}
    )
    joined = keyed.join(
        counts.withColumnRenamed("content_digest", "__digest"), "__digest"
    )
    return joined.withColumn("over_limit", F.col("n_tokens") > limit).drop("__digest")


def fill_cache(
    docs: DataFrame,
    cache: str,
    *,
    tokenizer: str = "word_bpe_49k.json",
    normalise: Callable[[Column], Column] = squeezed,
) -> None:
    """Append the counts of contents that the cache lacks; parameters as for ``count_tokens``.

    With counts stored before, only digests are shuffled to find what is missing: if that is
    nothing, no text leaves its scan, and if it is little, it is broadcast to the texts.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(public_path(tokenizer))
    text = normalise(F.coalesce("text", F.lit("")))
    contents = docs.select(F.unhex(F.sha2(text, 256)).alias("content_digest"), text.alias("content"))
    known = _read(spark, cache, version)
    if known is not None:
        digests = contents.select("content_digest").distinct()
        missing = settle(digests.join(known.select("content_digest"), "content_digest", "left_anti"))
        if missing.isEmpty():
            return
        contents = contents.join(broadcast_when_small(missing), "content_digest", "left_semi")
    counted = contents.dropDuplicates(["content_digest"]).mapInArrow(
        _counter(tokenizer), "content_digest binary, n_tokens long"
    )
    counted.select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode(
        "append"
    ).parquet(cache)


def _read(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Counts of one tokenizer version; two runs may have appended the same content."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == version)
    return rows.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(public_path(tokenizer))
        for batch in batches:
            n: list[int] = []
            for _, texts in slices(batch.column("content")):
                n += [len(ids) // 4 for ids in codec.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_digest"), pa.array(n, pa.int64())],
                names=["content_digest", "n_tokens"],
            )

    return run
