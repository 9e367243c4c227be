import math

import numpy as np
from odd import whole
from pyspark.sql import functions as F

from noteloom.llm import multi_index as x

FOLDER = "/root/testdata/sf0.1"


def brute(rows, is_query, k=10):
    rows = [(i, np.array(v, dtype=np.float64)) for i, v in rows]
    result = {}
    for query, q in rows:
        if is_query(query):
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), i) for i, v in rows if i != query)
            result[query] = near[:k]
    return result


def test_traversal_goes_by_summed_distance():
    rng = np.random.default_rng(0)
    first, second = rng.random(7), rng.random(5)
    sizes = rng.integers(0, 3, 35)
    seen = list(x.traverse(first, second, sizes, 10**9))
    sums = (first[:, None] + second[None, :]).ravel()
    assert seen == [c for c in np.argsort(sums, kind="stable").tolist() if sizes[c]]
    part = list(x.traverse(first, second, sizes, 6))
    assert part == seen[: len(part)] and sum(sizes[part[:-1]]) < 6 <= sum(sizes[part])


def test_recall_and_scores(spark):
    truth = brute(whole(FOLDER, "vec_id, embedding", "embeddings"), lambda i: i % 100 == 0)
    rows = x.op4_multi_index(spark, FOLDER).collect()
    met = 0
    for query, near in truth.items():
        found = sorted((r for r in rows if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in found] == sorted((r["score"], r["vec_id"]) for r in found)
        met += len({r["vec_id"] for r in found} & {i for _, i in near})
    assert met >= 0.9 * 10 * len(truth)
    assert {r["query_id"] for r in rows} == set(truth)


def saved(spark, rows, folder):
    spark.createDataFrame([(i, v, "z", 1.0) for i, v in rows], "vec_id long, embedding array<float>, cell string, score double").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    return str(folder)


def test_odd_vectors_ties_and_copies(spark, tmp_path):
    good = [(i, [1.0, float(i % 4), -0.0, 0.5]) for i in range(150)] + [(200, [9.0, 9.0, 9.0, 9.0]), (300, [9.0, 9.0, 9.0, 9.0])]
    bad = [
        (400, None), (500, []), (600, [0.0] * 4), (700, [1.0, None, 1.0, 1.0]), (800, [math.nan, 1.0, 1.0, 1.0]),
        (900, [math.inf, 1.0, 1.0, 1.0]), (1000, [1.0, 2.0]), (None, [1.0, 1.0, 0.0, 0.5]),
    ]
    rows = x.op4_multi_index(spark, saved(spark, [*good, good[5], *bad], tmp_path)).collect()
    truth = brute(good, lambda i: i % 100 == 0)
    found = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert found == truth


def test_fewer_candidates_than_asked_for(spark, tmp_path):
    rows = x.op4_multi_index(spark, saved(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], tmp_path)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(rows)] == [(0, 1, 2, 1.0), (0, 2, 1, math.sqrt(2))]


def test_nothing_to_search(spark, tmp_path):
    assert x.op4_multi_index(spark, saved(spark, [], tmp_path)).collect() == []


def test_one_vector_of_many_rows(spark):
    rows = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.when(F.col("id") < 1500, 2.0).otherwise(F.col("id"))).alias("embedding"))
    found = x.search(rows, F.col("id") % 500 == 0).collect()
    for query in (0, 500, 1000):
        want = [i for i in range(12) if i != query][:10]
        assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == query] == want
