import re

import numpy as np

from meterline.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {
        j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)
    }
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_base_counts():
    texts = [None, "", " \n\t", "a", "a b c a b c", "a a a a a", "x y z\nx y z\n\n \nx y z",
             "é 中 😀 é 中 😀 # * $$ | <>", "a\x0bb\x0cc\rd\x1ce\x85f\xa0g", "one two three four"]
    for text in texts:
        assert quality.base_counts(text) == brute(text)


def test_query_on_given_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = queries.op4_quality_rules(spark, SF).collect()
    assert len(found) == len(texts)
    good, bad = [], []
    for r in found:
        n, chars, symbols, dup, repeat = brute(texts[r["doc_id"]])
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] in labels and not r["base_failed"]:
            (good if labels[r["doc_id"]] else bad).append(r["kept"])
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_score_is_the_mean_log_ratio(spark):
    docs = spark.createDataFrame(
        [(i, f"plain words number {i} of the text") for i in range(40)]
        + [(100 + i, f"## || $$ {i} ||") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.score(docs, model, ["doc_id"]).collect():
        places = quality.grams(texts[r["doc_id"]])
        assert abs(r["score"] - sum(model.ratios[p] for p in places) / len(places)) < 1e-12
        assert (r["score"] > 0) == (r["doc_id"] < 100)


def test_reruns_agree_however_rows_lie(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    once, again = (sorted((r["doc_id"], r["kept"]) for r in quality.judge(d, labels, ["doc_id"]).collect())
                   for d in (docs, docs.repartition(7)))
    assert once == again


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (5, 1)],
                                   "doc_id long, quality int")
    found = quality.judge(odd_docs, labels, ["doc_id"]).collect()
    assert len(found) == odd_docs.count()
    assert {r["doc_id"] for r in found if r["kept"]} <= {1, 2, 5}
    none = labels.where("false")
    assert quality.judge(odd_docs, none, ["doc_id"]).where("kept").count() == 4
    assert quality.judge(no_docs, labels, ["doc_id"]).count() == 0
    assert quality.judge(no_docs, none, ["doc_id"]).count() == 0


def test_label_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    assert quality.sampled_labels(labels, 10).count() == 20


def test_grams_count_every_place():
    for text in ["", "ab", "abc", "abcd", "é"]:
        n = len(text.encode())
        assert len(quality.grams(text)) == max(0, n - 2) + max(0, n - 3)
