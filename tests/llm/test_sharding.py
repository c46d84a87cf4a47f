import zlib
from collections import defaultdict

import numpy as np

from roadpulse.llm.sharding import WEIGHTS, place, shard_rows


def _check(df, n, share):
    rows = shard_rows(df, n).collect()
    assert len(rows) == df.count()
    have = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows) == have
    slots, loads = defaultdict(list), defaultdict(int)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    if rows:
        mean = sum(loads.values()) / n
        assert max(loads.values()) - min(loads.get(s, 0) for s in range(n)) <= share * mean
    return rows


def test_documents(spark, documents):
    rows = _check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 24, 0.02)
    where = defaultdict(set)
    for r in rows:
        where[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())  # equal texts lie together
    again = shard_rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7), 24).collect()
    assert sorted(rows) == sorted(again)  # whatever the layout of the input


def _place(loads, n_shards, weights):
    """The placement by plain loops."""
    total = [sum(x[k] for x in loads) or 1 for k in range(3)]
    residual = [list(weights) for _ in range(n_shards)]
    out = {}
    for i in sorted(range(len(loads)), key=lambda i: (-loads[i][0], i)):
        unit = [loads[i][k] / total[k] * n_shards * weights[k] for k in range(3)]
        gain = [sum(r * u for r, u in zip(row, unit, strict=True)) for row in residual]
        best = max(gain)
        out[i] = next(s for s in range(n_shards) if gain[s] >= best - 1e-12 * max(1, abs(best)))
        residual[out[i]] = [r - u for r, u in zip(residual[out[i]], unit, strict=True)]
    return [out[i] for i in range(len(loads))]


def test_placement_equals_plain_loops():
    rng = np.random.default_rng(6)
    for n, shards in ((1, 3), (7, 7), (200, 5), (400, 24)):
        loads = np.column_stack([rng.integers(1, 10_000, n), rng.integers(0, 900, n), rng.integers(1, 5, n)]).astype(float)
        assert place(loads, shards).tolist() == _place(loads.tolist(), shards, WEIGHTS)
    assert place(np.zeros((4, 3)), 2).shape == (4,)


def test_ties_and_equal_loads(spark):
    rows = [(i, f"text of equal length {i:04d}") for i in range(240)]
    placed = shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    again = shard_rows(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5), 8).collect()
    assert sorted(placed) == sorted(again)
    assert all(r.slot >= 0 for r in placed) and len({(r.shard, r.slot) for r in placed}) == 240


def test_a_group_of_a_third_of_all_rows_is_spread(spark):
    rows = [(i, "the same text for all of these " * 20) for i in range(500)] + [(1000 + i, f"text {i} " * (20 + i % 97)) for i in range(1000)]
    _check(spark.createDataFrame(rows, "doc_id long, text string"), 8, 0.03)


def test_odd_rows(odd, empty):
    _check(odd, 4, 99)
    assert shard_rows(empty, 4).count() == 0


def test_a_group_of_repeated_or_null_ids_is_spread(spark):
    for own in (None, 7):
        rows = [(own, "the same text for all of these " * 20)] * 500 + [(1000 + i, f"text {i} " * (20 + i % 97)) for i in range(1000)]
        _check(spark.createDataFrame(rows, "doc_id long, text string"), 8, 0.03)
