import random
import re

import pytest
import xxhash

from meterline.llm import queries, simhash
from tests.llm.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(docs):
    prints = [brute_print(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)),
                  key=lambda t: [str(x) for x in t])


def test_query_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    assert rows(queries.op8_simhash(spark, SF), "doc_id", "fingerprint", "component_id") == brute(docs)


def test_odd_documents(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = simhash.near_duplicates(odd_docs)
    assert rows(found, "doc_id", "fingerprint", "component_id") == brute(docs)
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_per_group(no_docs).count() == 0


@pytest.mark.parametrize("text", ["a", "A b", "x y z", "ÄÖ Z\x0bq\x1cw e", "w " * 4000])
def test_fingerprints(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_print(text)


@pytest.mark.parametrize("group", [1, 3, 1024])
def test_links_join_what_all_pairs_join(spark, group):
    rng = random.Random(8)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(25):
            base ^= 1 << rng.randrange(64)
            prints.add(base)
            prints.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.linked(spark.createDataFrame([(p,) for p in prints], "fp long"), group).collect()
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 and a != b for a, b in links)
    assert classes(prints, links) == classes(
        prints, [(a, b) for a in prints for b in prints if ((a ^ b) % (1 << 64)).bit_count() <= 2])


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}


def test_one_document_of_each_group_stays(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    left = simhash.one_per_group(docs.unionByName(docs.limit(20)))
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({c for _, _, c in brute(plain)})
    odd = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    # Two components hold the id 7.
    assert simhash.one_per_group(odd_docs).count() == len({c for _, _, c in brute(odd)}) + 1
