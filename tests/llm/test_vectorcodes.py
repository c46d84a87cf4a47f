import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from roadpulse.llm import vectorcodes
from roadpulse.llm.vectorcodes import Book, compress, table

LONG = 2**63 - 1
ROW = "vec_id long, embedding array<double>, label int"


def _brute(rows, parts=4, entries=256, rounds=4):
    """Every piece against every entry in every round, in whole numbers."""
    rows = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return []
    size = len(rows[0][1])
    width = -(-size // parts)
    whole = lambda v: math.floor(v * 1024) if abs(v) < 2.0**900 else int(v) * 1024
    first = rows[:entries]
    vectors = lambda own: [[whole(v) for v in r[1]] + [0] * (width * parts - size) for r in own if len(r[1]) == size]
    books = [[v[p * width:(p + 1) * width] for v in vectors(first)] for p in range(parts)]
    rows = [r for r in rows if len(r[1]) == size]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in vectors(rows)]
    for k in range(rounds + 1):
        best = [[min((sum((a - b) ** 2 for a, b in zip(piece, e, strict=True)), i) for i, e in enumerate(books[p])) for p, piece in enumerate(v)] for v in cut]
        if k < rounds:
            held = defaultdict(list)
            for v, own in zip(cut, best, strict=True):
                for p, (_, i) in enumerate(own):
                    held[p, i].append(v[p])
            for (p, i), pieces in held.items():
                books[p][i] = [sum(c) // len(pieces) for c in zip(*pieces, strict=True)]
    errors = [min(LONG, sum(d for d, _ in own)) for own in best]
    of = defaultdict(int)
    for r, e in zip(rows, errors, strict=True):
        of[r[2]] = min(LONG, of[r[2]] + e)
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in own), e, of[r[2]], sha) for r, own, e in zip(rows, best, errors, strict=True)), key=str)


def _rows(found):
    return sorted(map(tuple, found.collect()), key=str)


def _table(spark, rows):
    return spark.createDataFrame(rows, ROW).repartition(3)


def test_whole_table(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in given.collect()]
    assert _rows(table(given, entries=16)) == _brute(rows, entries=16)


def test_many_rounds_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(v) / 1024 for v in rng.integers(-4, 5, 8)], int(i % 3)) for i in rng.permutation(400)]
    for entries, rounds in ((3, 8), (40, 5)):
        got = _rows(table(_table(spark, rows), entries=entries, rounds=rounds))
        assert got == _brute(rows, entries=entries, rounds=rounds)


def test_fixed_pieces_meet_moved_entries_only(monkeypatch):
    rng = np.random.default_rng(1)
    entries = rng.integers(-50, 50, (20, 4)).tolist()
    book, pieces = Book(entries, 4), rng.integers(-50, 50, (60, 4)).astype(float)
    every = np.ones(20, bool)
    code, best = book.nearest(pieces, every)
    some = every.copy()
    some[code[0]] = False
    at, d = book.nearest(pieces, some)
    assert at[0] != code[0] and d[0] >= best[0]
    assert book.nearest(pieces, ~every)[0].tolist() == [-1] * 60


@pytest.mark.parametrize("large", [2.0**30, 1e12, 1e30, -1e300, 1.7e308])
def test_any_finite_component(spark, large):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), i % 2) for i in range(40)]
    rows[3][1][2] = large
    rows[20][1][2] = large
    rows[30][1][5] = -large / 3
    assert _rows(table(_table(spark, rows), entries=6, rounds=3)) == _brute(rows, entries=6, rounds=3)


def test_components_about_the_bound(spark):
    edge = 2.0 ** vectorcodes._bits(2) / 1024
    rows = [(i, [edge - 2 + i / 8, -edge + 2 - i / 8, 0.5, i / 7, 0.0, edge, -edge, 1.0], None) for i in range(30)]
    assert _rows(table(_table(spark, rows), entries=5, rounds=3)) == _brute(rows, entries=5, rounds=3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -0.25, 1.0, 2.0]
    rows = [(9, None, 1), (1, [None, 1.0, 1.0, 1.0], 1), (2, [nan] * 4, 1), (3, [1.0, inf, 0.0, 0.0], 1), (4, good, None), (5, good, None),
            (5, good, 7), (None, [3.0, 3.0, 3.0, 3.0], None), (6, [0.0, 0.0], 1), (7, [], 1), (8, [-v for v in good], 7)]
    found = table(_table(spark, rows).selectExpr("*", "1 AS code", "2 AS error", "3 AS part", "4 AS q", "5 AS `a.b`"))
    assert _rows(found) == _brute(rows)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert table(_table(spark, rows).filter("false")).count() == 0
    assert table(_table(spark, rows[:4])).count() == 0


@pytest.mark.parametrize("size", [0, 1, 3, 6])
def test_lengths_that_parts_do_not_divide(spark, size):
    rows = [(i, [float((i * 7 + j * 3) % 5) for j in range(size)], i % 2) for i in range(25)]
    assert _rows(table(_table(spark, rows), entries=4, rounds=2)) == _brute(rows, entries=4, rounds=2)


def test_one_label_and_vector_of_a_third_of_all_rows(spark):
    rows = [(7, [0.1, 0.2, 0.3, 0.4], 1)] * 100 + [(100 + i, [i / 9, 0.0, i % 4 / 3, 1.0], i) for i in range(200)]
    assert _rows(table(_table(spark, rows), entries=10, rounds=2)) == _brute(rows, entries=10, rounds=2)


def test_codebooks_and_codes_decode(spark):
    rows = [(i, [i % 3 + 0.5, i % 2 + 0.25, 1.0, 0.0], 0) for i in range(60)]
    found, books = compress(_table(spark, rows), entries=6, rounds=3)
    for r in found.join(_table(spark, rows).select("vec_id", "embedding"), "vec_id").collect():
        back = [v for p, c in enumerate(r.codes) for v in books[p][c]]
        assert sum((math.floor(1024 * x) - v) ** 2 for x, v in zip(r.embedding, back, strict=True)) == r.error
