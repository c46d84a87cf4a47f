import random

import numpy as np
import pytest

from roadpulse.llm import simhash
from roadpulse.llm.components import components
from tests.llm.brute import fingerprint, near_groups


def test_documents(documents):
    rows = simhash.near_duplicates(documents).collect()
    prints = {r.doc_id: fingerprint(r.text) for r in documents.collect()}
    groups = near_groups(prints)
    assert len(rows) == len(prints)
    for r in rows:
        assert r.f % 2**64 == prints[r.doc_id] and r.component_id == groups[r.doc_id]


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.f == 0]
    assert {r.doc_id for r in zero} >= {1, 2, 3, 11, None} and {r.component_id for r in zero} == {1}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("blocks", "tile_rows"), [(4, 8192), (4, 16), (8, 64), (2, 32), (1, 50)])
def test_links_are_complete(spark, blocks, tile_rows):
    rng = random.Random(blocks * 100 + tile_rows)
    values = set()
    for _ in range(60):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains of small steps
            values.add(value)
            for _ in range(rng.randint(0, 3)):
                value ^= 1 << rng.randrange(64)
    values |= {0, 2**64 - 1, 1, 3, 7, 15, 31}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "f long")
    want = near_groups({v: v % 2**64 for v in signed})
    got = {r.node: r.root for r in components(simhash.links(nodes, 2, blocks=blocks, tile_rows=tile_rows)).collect()}
    mine = {v: got.get(v, v) for v in signed}
    assert {frozenset(v for v in signed if mine[v] == r) for r in set(mine.values())} == \
        {frozenset(v for v in signed if want[v] == r) for r in set(want.values())}


def test_dense_groups_hand_on_few_links():
    rng = np.random.default_rng(3)
    rows = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    a, b = simhash.star(rows, rows, 2)
    assert len(a) == len(rows) - 1 and len(set(b.tolist())) == 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7002, 7001)]
    names = list(range(8000))
    rng.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (range(201), range(1000, 1300), (7001, 7002)):
        own = [names[i] for i in part]
        assert {got.get(v, v) for v in own} == {min(own)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_many_cells_without_a_forced_broadcast(spark):
    rng = np.random.default_rng(12)
    base = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, near[:50] ^ np.uint64(3 << 20)]))
    links = simhash.links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "f long"), 2, blocks=8)
    got = {r.node: r.root for r in components(links).collect()}
    want = {}
    for i, v in enumerate(values):
        close = np.flatnonzero(np.bitwise_count(values ^ v) <= 2)
        if len(close) > 1:
            want[int(values.view(np.int64)[i])] = len(close)
    assert want.keys() == got.keys() | set(got.values()) and len(want) >= 600
    from roadpulse.llm.common import written
    nodes = written(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "f long"), "nodes")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plans = {b: simhash.links(nodes, 2, blocks=b)._jdf.queryExecution().executedPlan().toString() for b in (4, 8)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plans[4] and "BroadcastHashJoin" not in plans[8]
    with pytest.raises(ValueError):
        simhash.links(nodes, 2, blocks=16)
