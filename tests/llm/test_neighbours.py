import math

import numpy as np
from pyspark.sql import functions as F

from meterline.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, ask, k=20):
    """All rows against all queries, summed in order in double precision."""
    out = {}
    for q, v in rows:
        if ask(q):
            scores = []
            for i, u in rows:
                if i != q:
                    total = 0.0
                    for a, b in zip(v, u):
                        total += float(a) * float(b)
                    scores.append((-total, i))
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    got = found(queries.op5_nearest_neighbours(spark, sf))
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got)
    assert recall(got, want) >= 0.9
    vectors = dict(rows)
    for q, near in got.items():
        for i, score in near:
            assert score == sum_of(vectors[q], vectors[i])


def sum_of(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def test_few_rows_are_all_found(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(15)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0))
    assert got == brute(rows, lambda i: i % 5 == 0)


def test_short_queries_fall_back_to_all(spark):
    # One table and one probe give most queries too few rows.
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=32)]) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbours.nearest(df, F.col("vec_id") % 30 == 0, tables=1, probes=1))
    assert got == brute(rows, lambda i: i % 30 == 0)


def test_equal_vectors_ties_and_unusable_ones(spark):
    base = [1.0, 0.5, -0.25, 0.0]
    rows = [(i, base) for i in range(60)] + [(100, [0.5, 0.5, 0.5, 0.5]), (101, [-1.0, 0.0, 0.0, 0.0])]
    bad = [(200, None), (220, []), (240, [0.0] * 4), (260, [float("nan"), 1.0, 1.0, 1.0]),
           (280, [math.inf, 0.0, 0.0, 0.0]), (300, [1.0, None, 1.0, 1.0]), (None, base)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + bad], SCHEMA + ", rank int, own int, cid long")
    got = found(neighbours.nearest(df, F.col("vec_id") % 20 == 0))
    assert got == brute(rows, lambda i: i % 20 == 0)


def test_repeated_ids_and_other_lengths(spark):
    """Rows of one id are rows like others, and vectors of a length are searched among themselves."""
    rng = np.random.default_rng(6)
    made = [(i % 90, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    made += made[:40] + [(7, [1.0] * 3), (20, [0.5, 0.5, 0.25]), (20, [0.5, 0.5, 0.25]), (40, [1.0] * 5)]
    got = neighbours.nearest(spark.createDataFrame(made, SCHEMA), F.col("vec_id") % 20 == 0, k=9).collect()
    want = []
    for at, (q, v) in enumerate(made):
        if q % 20 == 0:
            near = sorted((-sum_of(v, u), i) for j, (i, u) in enumerate(made) if j != at and len(u) == len(v))
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(near[:9], 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_unequal_lengths_go_by_inner_product(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16) * rng.uniform(0.2, 3)])
            for i in range(500)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert recall(got, brute(rows, lambda i: i % 20 == 0)) >= 0.9


def test_large_bucket_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUCKET", 50)
    rng = np.random.default_rng(2)
    center = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in center + 0.01 * rng.normal(size=16)]) for i in range(400)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 40 == 0))
    assert recall(got, brute(rows, lambda i: i % 40 == 0)) == 1


def test_several_hashes(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(10, 16))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 10] + 0.1 * rng.normal(size=16)])
            for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbours.nearest(df, F.col("vec_id") % 50 == 0, hashes=2, probes=3))
    assert recall(got, brute(rows, lambda i: i % 50 == 0)) >= 0.9


def test_no_vectors(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert neighbours.nearest(one, F.col("vec_id") % 20 == 0).count() == 0


def test_transform_is_orthonormal():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = neighbours.hadamard(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(neighbours.hadamard(y), x)


def test_hashes_do_not_grow_with_the_number_of_vectors(spark, monkeypatch):
    used = []
    init = neighbours.Hasher.__init__

    def watched(self, dims, top, tables, hashes, seed):
        used.append(hashes)
        init(self, dims, top, tables, hashes, seed)

    monkeypatch.setattr(neighbours.Hasher, "__init__", watched)
    # 1,200,000 vectors of two dimensions, where the former switch gave more than one hash.
    rows = spark.range(1_200_000).select(
        F.col("id").alias("vec_id"),
        F.array(F.cos(F.col("id") % 50), F.sin(F.col("id") % 50)).cast("array<float>").alias("embedding"),
    )
    neighbours.nearest(rows, F.col("vec_id") == 0)
    assert used == [neighbours.HASHES]


def test_recall_of_the_production_parameters(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in table], np.float64)
    asked = [i for i, r in enumerate(table) if r["vec_id"] % 20 == 0]
    recalls = []
    for hashes in (neighbours.HASHES, 2, 3):
        hasher = neighbours.Hasher(x.shape[1], None, neighbours.TABLES, hashes, 7)
        own = hasher.buckets(x, 1, False)
        hits = 0
        for i, probed in zip(asked, hasher.buckets(x[asked], neighbours.PROBES, True)):
            scores = x @ x[i]
            scores[i] = -np.inf
            hits += np.isin(own[np.argsort(-scores)[:20]], probed).any(axis=1).sum()
        recalls.append(hits / (20 * len(asked)))
    assert recalls[0] >= 0.9 > recalls[1] > recalls[2]
