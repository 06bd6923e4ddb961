import itertools

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from meterline.llm import mixing, paragraphs, quality
from tests.llm import test_paragraphs, test_simhash

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], SF).write.parquet(f"{tmp_path}/{i}")
        steps.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    plain = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in steps[:-1]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    kept = quality.judge(docs, labels, ["doc_id"]).where("kept").collect()
    assert sorted(d for d, _ in plain[1]) == sorted(r["doc_id"] for r in kept)
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    long = {d for d, t in plain[0] if len(t.encode().split()) >= 50}
    assert np.mean([d in dict(plain[1]) for d in good & long]) > 0.97

    assert sorted(d for d, _ in plain[2]) == sorted({c for _, _, c in test_simhash.brute(plain[1])})

    want = without_repeats(plain[2])
    assert {d: t.encode().split() for d, t in plain[3] if t} == {d: w for d, w in want.items() if w}
    same = {d for d, t in plain[2] if len(want[d]) == len(t.encode().split())}
    assert {d: t for d, t in plain[3] if d in same} == {d: t for d, t in plain[2] if d in same}

    mixed = mixing.mix(steps[3]).collect()
    words = sum(len(t.encode().split()) for _, t in plain[4])
    assert words == sum(r["taken"] for r in mixed)
    pieces = steps[5].collect()
    assert sum(p["length"] for p in pieces) >= words
    assert {p["doc_id"] for p in pieces} == {d for d, _ in plain[4]}
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == len(pieces)


def without_repeats(docs, size=paragraphs.PASSAGE):
    """Words left of each text after repeated paragraphs, then repeated runs of words, by looking
    at all pairs of paragraphs and at all windows."""
    removed = {(d, p) for d, p, gone in test_paragraphs.brute(docs) if gone}
    seen, left = {}, {}
    for doc, text in sorted(docs):
        words = text.encode().split()
        gone = set()
        for line, first, own in paragraphs.units_of(text):
            if (doc, line) in removed:
                gone |= set(range(first, first + len(own)))
        ends = [-1, *sorted(gone), len(words)]
        later = set()
        for a, b in itertools.pairwise(ends):
            for i in range(a + 1, b - size + 1):
                first = seen.setdefault(tuple(words[i : i + size]), (doc, i))
                if first[0] != doc or i - first[1] >= size:
                    later |= set(range(i, i + size))
        left[doc] = [w for i, w in enumerate(words) if i not in gone | later]
    return left


def test_run_gives_the_last_stages_rows(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == result_columns() and found.count() > 0


def result_columns():
    return ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names}
    assert "pipeline" in names


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for docs, name in ((odd_docs, "odd"), (no_docs, "none")):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{i}")
