import random

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import linededup
from roadpulse.llm.queries import op2_line_dedup
from tests.llm.brute import cut_lines, sha, words


def _check(spark, docs, min_lines=2):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = linededup.table(df, min_lines=min_lines).collect()
    want = cut_lines(docs, min_lines)
    assert len(rows) == len(docs)
    for r in rows:
        text, gone = want[r.doc_id]
        assert (r.n_removed, r.kept_sha256) == (gone, sha(text)), r.doc_id
    return rows


@pytest.mark.parametrize("min_lines", [1, 2])
def test_documents(spark, documents, min_lines):
    _check(spark, [(r.doc_id, r.text) for r in documents.collect()], min_lines)


def test_the_query_leaves_no_later_copy_of_a_line(spark):
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen, later = set(), {}
    for r in documents.orderBy("doc_id").collect():
        for line in (r.text or "").split("\n"):
            if words(line):
                later[r.doc_id] = later.get(r.doc_id, 0) + (line in seen)
                seen.add(line)
    assert sum(later.values()) > 50
    assert {r.doc_id: r.n_removed for r in op2_line_dedup(spark, sf_dir).collect() if r.n_removed} == {i: n for i, n in later.items() if n}


@pytest.mark.parametrize(("seed", "min_lines"), [(1, 2), (2, 4), (3, 1), (4, 2)])
def test_random_lines(spark, seed, min_lines):
    rng = random.Random(seed)
    pool = [f"line {k}" for k in range(6)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    docs += [(40 + i, docs[i][1]) for i in range(5)] + [(50, "\n".join(["same"] * 70)), (51, "\n".join(["same"] * 33))]
    _check(spark, docs, min_lines)


def test_depths_are_those_of_the_suffix_array(spark):
    block = [f"x{k}" for k in range(21)]
    docs = [(0, "\n".join(["a", *block, "b"])), (1, "\n".join(["c", *block, "d"])), (2, "\n".join(block[5:9]))]
    lines = linededup.line_table(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {(r["__id"], r.pos): r.depth for r in linededup.repeated_runs(lines).collect()}
    for at in range(21):  # the longest power of two that still fits into what the first document repeats
        left = 21 - at
        if left >= 2:
            assert got[1, 1 + at] == 1 << (left.bit_length() - 1)
    assert (0, 1) not in got and got[2, 0] == 4


def test_odd_rows(odd, empty):
    out = linededup.cut(odd).select("__row.*", "__kept", "__n_lines", "__n_removed")
    rows = out.collect()
    assert len(rows) == odd.count() and set(odd.columns) <= set(out.columns)
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 6, 9)}
    assert by_id[1]["__kept"] is None and by_id[2]["__kept"] == "" and by_id[3]["__n_lines"] == 0
    assert by_id[8]["__n_removed"] == 0
    nine = [r for r in rows if r.doc_id == 9]
    assert sorted(r["__kept"] for r in nine) == ["another text with the same id", "before it.\nafter it."]
    assert by_id[12]["__kept"] == "\n\ntail"  # the blank lines behind the block went with its last line
    assert linededup.table(empty).count() == 0


def test_blank_lines_belong_to_the_line_before(spark):
    docs = [(0, "one\n\ntwo\nthree"), (1, "zero\none\ntwo\n\nfour")]
    rows = {r.doc_id: r for r in linededup.cut(spark.createDataFrame(docs, "doc_id long, text string")).select("__row.*", "__kept", "__n_lines").collect()}
    assert rows[0]["__kept"] == docs[0][1]
    assert rows[1]["__kept"] == "zero\nfour" and rows[1]["__n_lines"] == 4


def test_no_python_on_executors(documents):
    plan = linededup.table(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_very_common_line(spark):
    docs = [(i, "\n".join(["common", f"own {i}", "common", f"other {i}"])) for i in range(400)] + [(500 + i, "common\nshared") for i in range(200)]
    rows = _check(spark, docs)
    assert sum(r.n_removed for r in rows) == 199 * 2


def test_min_lines_must_be_a_power_of_two(spark, documents):
    with pytest.raises(ValueError):
        linededup.repeated_runs(documents.select(F.lit(1)), 3)
