import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm.topk import SlicedBlock, _encoded, dealt, quantised, top_k


def _brute(ids, vectors, queries, k):
    want = []
    for q in queries:
        others = [(-int(np.dot(vectors[ids.index(q)], v)), i) for i, v in zip(ids, vectors, strict=True) if i != q]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(others)[:k], 1)]
    return want


@pytest.mark.parametrize(("n", "spread"), [(1, 5), (7, 0), (64, 3), (200, 900), (1000, 2)])
def test_blocks(n, spread):
    rng = np.random.default_rng(n)
    vectors = rng.integers(-spread, spread + 1, (n, 9))
    ids = rng.permutation(n * 3)[:n]
    block = SlicedBlock(ids, vectors)
    for at in range(0, n, max(1, n // 7)):
        got, score = block.top(int(ids[at]), vectors[at], 10)
        want = _brute(ids.tolist(), vectors, [int(ids[at])], 10)
        assert sorted(zip((-score).tolist(), got.tolist(), strict=True)) == [(-s, i) for _, _, i, s in want]


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    v = quantised(table)
    rows = v.orderBy("vec_id").collect()
    got = top_k(v, v.filter("vec_id % 100 = 0"), block_rows=100).collect()
    ids = [r.vec_id for r in rows]
    vectors = [np.array(r.q) for r in rows]
    want = _brute(ids, vectors, [i for i in ids if i % 100 == 0], 10)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (6, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [0.5, 0.5]),
            (9, [1.0, 1.0, 1.0]), (100, [-1.0, 0.001]), (200, []), (None, [9.0, 9.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    v = quantised(df)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(v, v.filter("vec_id % 100 = 0"), 3).orderBy("query_id", "rank").collect()]
    assert got[:3] == [(0, 1, None, 9216 * 1024 + 9216 * 2048), (0, 2, 6, 512 * 1024 + 512 * 2048), (0, 3, 7, 512 * 1024 + 512 * 2048)]
    assert [x for x in got if x[0] == 200] == [(200, 1, 5, 0)]
    assert [x[2] for x in got if x[0] == 100] == [6, 7, 8]
    assert top_k(v.filter("false"), v.filter("false")).count() == 0


def _whole(v):
    return math.floor(v * 1024) if abs(v) < 2.0**900 else int(v) * 1024


@pytest.mark.parametrize("large", [2.0**29 - 1, 2.0**29, 2.0**31, 2.0**41, 1e18, 1e30, 3.4e38, 1e300, -1.7e308])
def test_any_finite_component(spark, large):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)]
    for i, at in ((0, 0), (7, 1), (20, 0), (50, 2)):
        rows[i][1][at] = large * (1 if i != 20 else -0.5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = quantised(df)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k(v, v.filter("vec_id % 10 = 0"), 5, block_rows=16).collect()}
    whole = {i: [_whole(c) for c in x] for i, x in rows}
    for q in range(0, 60, 10):
        want = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), i) for i, w in whole.items() if i != q)[:5]
        for rank, (s, i) in enumerate(want, 1):
            assert got[q, rank] == (i, max(-2**63, min(2**63 - 1, -s))), (q, rank)


def test_scores_beyond_a_long_are_ordered():
    scores = [0, 5, -5, 2**63 - 1, 2**63, 2**63 + 1, 10**40, 10**40 + 1, 10**400, -2**63 + 1, -2**63 - 7, -10**40, -10**400]
    assert sorted(scores) == sorted(scores, key=_encoded)


def test_a_vector_is_shuffled_once_and_a_query_once_a_block(spark):
    v = quantised(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).withColumn("row", F.monotonically_increasing_id())
    asked = v.filter("vec_id % 100 = 0").drop("row")
    laid = dealt(v, asked, 7)
    assert laid.count() == v.count() + 7 * asked.count()
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    where = laid.withColumn("part", F.spark_partition_id()).select("block", "part").distinct().collect()
    assert len(where) == 7 and len({r.part for r in where}) == 7  # a partition of its own for every block


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0])] * 200 + [(None, [1.0, 0.0])] * 100 + [(100, [1.0, 1.0]), (2, [0.5, 0.0])]
    v = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = top_k(v, v.filter("vec_id % 100 = 0"), 250, block_rows=50).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1] * 200 + [None] * 50
