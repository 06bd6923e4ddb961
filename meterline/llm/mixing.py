"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get targets by weight, bounded by a number of repeats. The targets are votes for equal
blocks of words: the highest quotients ``votes / (2k + 1)`` win the blocks, first among sources,
then among the shards of a source. In a shard the documents lie in a seeded order, and the quota
is a run of blocks from a seeded start around that order, so a quota of more than the shard's
words repeats whole documents before it cuts any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import WORD, settle, word_count
from meterline.plans.sizing import broadcast_when_small

_SPACES = r"[\x20\x09-\x0D]*"


def water_fill(sources: DataFrame, total, max_repeats: float) -> DataFrame:
    """Add ``target``: weight * level, at most ``max_repeats`` times ``source_size``.

    ``sources`` holds one row per source with ``source_size`` and ``weight``. The level is where
    the targets add up to ``total``, which is what resharing the excess again and again ends at.
    """
    cap = F.col("source_size") * F.lit(max_repeats)
    order = Window.orderBy("__ratio", "__rank")
    before = F.sum("__cap").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("__cap", cap.cast("double"))
        .withColumn("__ratio", F.col("__cap") / F.col("weight"))
        .withColumn("__level", (total - F.coalesce(before, F.lit(0.0))) / rest)
        .withColumn("__level", F.max("__level").over(Window.partitionBy()))
        .withColumn("target", F.least("__cap", F.col("weight") * F.col("__level")))
        .drop("__cap", "__ratio", "__level")
    )


def sainte_lague(parties: DataFrame, groups: list[str], votes: str, seats, order: list[str]):
    """Add ``quota``: the seats each party wins of its group's ``seats`` by highest quotients.

    A party's seats differ by less than half a seat per party from its share, so all below that
    band are given at once and only the quotients inside the band, about two per party, are
    ranked; the outcome is that of ranking every quotient. Ties go by ``order``. A group without
    votes gives no seats.
    """
    group = Window.partitionBy(*groups)
    share = F.try_divide(F.col(votes), F.sum(votes).over(group))
    half = F.count(F.lit(1)).over(group) / 2
    low = F.floor(share * (F.col("__seats") - half) + 0.5)
    high = F.ceil(share * (F.col("__seats") + half) + 0.5)
    ready = (
        parties.withColumn("__seats", seats)
        .withColumn("__low", F.greatest(F.coalesce(low, F.lit(0)), F.lit(0)))
        .withColumn("__high", F.greatest(F.coalesce(high, F.lit(0)), F.col("__low")))
        .withColumn("__left", F.col("__seats") - F.sum("__low").over(group))
    )
    bids = ready.withColumn(
        "__bid", F.explode(F.sequence(F.col("__low"), F.col("__high")))
    ).withColumn("__quotient", F.col(votes) / (F.col("__bid") * 2 + 1))
    rank = F.row_number().over(
        Window.partitionBy(*groups).orderBy(F.desc("__quotient"), *order, "__bid")
    )
    won = (rank <= F.col("__left")) & (F.col(votes) > 0)
    keep = [F.first(c).alias(c) for c in parties.columns if c not in {*groups, *order}]
    return (
        bids.withColumn("__won", won.cast("long"))
        .groupBy(*dict.fromkeys([*groups, *order]))
        .agg(*keep, (F.first("__low") + F.sum("__won")).alias("quota"))
    )


def mix(
    docs: DataFrame,
    *,
    cycle: Sequence[int] = (1, 2, 3),
    max_repeats: int = 3,
    block_words: int = 8,
    shard_words: int = 1 << 20,
    seed: int = 42,
) -> DataFrame:
    """Add how much of each document a mix of the sources takes.

    Input: ``doc_id``, ``text``, ``source`` and any other columns. Sources in code-point order,
    null last, weigh ``cycle``, repeated, and share the words of all documents; a target ends at
    ``max_repeats`` times the source's words. Adds (replacing columns of these names) ``size``,
    ``source_size``, ``target``, ``taken``, ``copies`` (whole copies taken) and ``spans`` (ranges
    of words, from and past the end, taken besides). Shards of a source hold about ``shard_words``
    words, so no task's group grows with the source.

    Null and empty texts have no words and are never taken. Repeated rows are documents of their
    own; which of two equal rows comes first makes no difference to the result. Rows of a null
    ``doc_id`` or ``source`` take part. An empty table gives an empty one. Sources are ranked in
    one task: they are the mix's configuration, and one row each.
    """
    sized = docs.drop("size", "source_size", "target", "taken", "copies", "spans").withColumns(
        {
            "size": word_count(F.col("text")),
            "__src": F.coalesce("source", F.lit("")),
            "__none": F.col("source").isNull(),
            "__key": F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))),
        }
    )
    source = ["__none", "__src"]
    totals = sized.groupBy(*source).agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("__rank", F.row_number().over(Window.orderBy(*source))).withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, cycle)), (F.col("__rank") - 1) % len(cycle) + 1),
    )
    everything = F.sum("source_size").over(Window.partitionBy())
    aimed = water_fill(ranked.withColumn("__all", everything), F.col("__all"), max_repeats)
    quotas = sainte_lague(
        aimed.withColumn("__one", F.lit(1)),
        ["__one"],
        "target",
        F.round(F.col("__all") / block_words).cast("long"),
        source,
    ).withColumns(
        {
            "__blocks": F.col("quota"),
            "__shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)),
        }
    )
    per_source = settle(
        quotas.select(*source, "source_size", "target", "__blocks", "__shards")
    )
    # Broadcast if it is small, so that texts are shuffled once, by shard, and never by source.
    placed = sized.join(broadcast_when_small(per_source), source).withColumn(
        "__shard", F.pmod(F.col("__key"), F.col("__shards"))
    )
    shards = placed.groupBy(*source, "__shard").agg(
        F.sum("size").alias("__words"), F.first("__blocks").alias("__blocks")
    )
    shards = sainte_lague(shards, source, "__words", F.col("__blocks"), ["__shard"]).select(
        *source,
        "__shard",
        "__words",
        F.least(F.col("quota") * block_words, F.col("__words") * max_repeats).alias("__take"),
    )
    order = Window.partitionBy(*source, "__shard").orderBy("__key", "doc_id", "size")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spread = F.greatest(F.lit(1), F.floor(F.col("__words") / block_words))
    first = F.pmod(F.xxhash64(F.lit(seed), *source, "__shard"), spread) * block_words
    run = F.col("__take") - F.col("copies") * F.col("__words")
    laid = (
        placed.withColumn("__from", F.coalesce(start, F.lit(0)))
        .join(shards, [*source, "__shard"])
        .withColumn(
            "copies",
            F.when(F.col("__words") > 0, F.floor(F.col("__take") / F.col("__words"))).otherwise(0),
        )
        .withColumn("__first", first)
        .withColumn("__last", F.col("__first") + run)
    )
    end = F.least("__last", "__words")
    wrapped = F.greatest(F.col("__last") - F.col("__words"), F.lit(0))
    spans = F.filter(
        F.array(_span(F.lit(0), wrapped), _span(F.col("__first"), end)),
        lambda s: s["to"] > s["from"],
    )
    partial = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return (
        laid.withColumn("spans", spans)
        .withColumn("taken", F.col("copies") * F.col("size") + partial)
        .select(
            *[c for c in sized.columns if not c.startswith("__")],
            "source_size",
            "target",
            "taken",
            "copies",
            "spans",
        )
    )


def _span(start, end):
    """The part of a document's words between two places of its shard."""
    size = F.col("size")
    inside = [F.least(F.greatest(x - F.col("__from"), F.lit(0)), size) for x in (start, end)]
    return F.struct(inside[0].cast("long").alias("from"), inside[1].cast("long").alias("to"))


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row per whole copy, then one per span with the text of its words.

    Takes the result of ``mix``; its columns stay and ``text`` is what is taken. White space
    after a word stays with it. Documents of which nothing is taken give no row.
    """
    none = F.lit(None).cast("struct<from:long,to:long>")
    copies = F.array_repeat(none, F.when(F.col("size") > 0, F.col("copies")).otherwise(0).cast("int"))
    parts = mixed.withColumn("__part", F.explode(F.concat(copies, F.col("spans"))))
    words = F.regexp_extract_all("text", F.lit(f"{WORD}{_SPACES}"), F.lit(0))
    wanted = F.slice(
        words,
        (F.col("__part.from") + 1).cast("int"),
        (F.col("__part.to") - F.col("__part.from")).cast("int"),
    )
    text = F.when(F.col("__part").isNull(), F.col("text")).otherwise(F.array_join(wanted, ""))
    return parts.withColumn("text", text).drop("__part")
