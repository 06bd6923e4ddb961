import random
import re

from pyspark.sql import functions as F

from meterline.llm import mixing, queries
from tests.llm.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def highest_quotients(votes, seats):
    won = {k: 0 for k in votes}
    for _ in range(seats):
        best = max((v / (2 * won[k] + 1), -k) for k, v in votes.items() if v)
        won[-best[1]] += 1
    return won


def test_apportionment_is_that_of_all_quotients(spark):
    rng = random.Random(5)
    parties, seats = [], {}
    for g in range(30):
        seats[g] = rng.choice([0, 1, 3, 10, 57, 400])
        parties += [(g, k, rng.choice([0, 1, 5, 40, 1000]) + rng.random() * (k % 3))
                    for k in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(parties, "g int, k int, votes double")
    wanted = F.element_at(F.create_map(*[F.lit(x) for p in seats.items() for x in p]), F.col("g"))
    found = mixing.sainte_lague(df, ["g"], "votes", wanted, ["k"])
    got = {(r["g"], r["k"]): r["quota"] for r in found.collect()}
    for g in seats:
        votes = {k: v for h, k, v in parties if h == g}
        if sum(votes.values()):
            assert {k: got[g, k] for k in votes} == highest_quotients(votes, seats[g])
        else:
            assert all(got[g, k] == 0 for k in votes)


def targets(sizes, cycle=(1, 2, 3), most=3):
    """Reshare the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=str.encode)
    names += [None] if None in sizes else []
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = {s for s in names if s not in capped}
        share = (total - sum(capped.values())) / max(1, sum(weight[s] for s in rest))
        over = {s: most * sizes[s] for s in rest if share * weight[s] > most * sizes[s]}
        if not over:
            return capped | {s: share * weight[s] for s in rest}
        capped |= over


def check(docs, result, block=8):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    wanted, taken = targets(sizes), dict.fromkeys(sizes, 0)
    own = sorted(((d, len(WORD.findall(t or "")), s) for d, t, s in docs), key=str)
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in result), key=str) == own
    for r in result:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - wanted[r["source"]]) < 1e-6 * max(1, wanted[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= block


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check(plain, mixing.mix(docs).collect())
    columns = ("doc_id", "size", "source_size", "target", "taken")
    again = queries.op2_mixing(spark, sf)
    assert again.columns == list(columns)
    assert rows(again, *columns) == rows(mixing.mix(docs.repartition(5)), *columns)


def test_many_shards_and_a_hot_source(spark):
    docs = [(i, "w " * (i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    # A shard's quota is cut to whole blocks, so each may miss its part by one.
    check(docs, mixing.mix(df, shard_words=500).collect(), block=8 * 40)


def test_texts_hold_the_words_taken(spark, odd_docs):
    mixed = mixing.mix(odd_docs)
    result = mixed.collect()
    check([(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()], result)
    texts = [len(WORD.findall(r["text"])) for r in mixing.mixed_texts(mixed).collect()]
    assert sum(texts) == sum(r["taken"] for r in result) and 0 not in texts


def test_no_documents(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_texts(mixing.mix(no_docs)).count() == 0


def test_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert {r["taken"] for r in mixing.mix(df).collect()} == {0}
