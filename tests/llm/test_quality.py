import numpy as np
import pytest

from roadpulse.llm import quality
from tests.llm.brute import quality_figures, vote_model


def _check(df):
    rows = quality.table(df).collect()
    texts = {}
    for r in df.collect():
        texts.setdefault(r.doc_id, set()).add(quality_figures(r.text))
    for r in rows:
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed and r.good >= 0.5)
    assert len(rows) == df.count()
    return rows


def test_figures_and_verdicts(documents):
    _check(documents)


def test_odd_rows(odd, empty):
    rows = {(r.doc_id, r.n_words): r for r in _check(odd)}
    assert rows[1, 0].base_failed and rows[2, 0].base_failed and rows[3, 0].base_failed
    assert not rows[4, 30_000].base_failed
    assert quality.table(empty).count() == 0
    kept = quality.kept(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(r.doc_id for r in quality.table(odd).filter("kept").collect() if r.doc_id)
    assert quality.kept(empty).count() == 0


def test_repeats_within_a_text(spark):
    w = [f"w{i}" for i in range(30)]
    texts = [" ".join(w + w), " ".join(w + w[:8]), " ".join(w + w[:7]), " ".join(["a"] * 40), " ".join(w[:9] + ["z"] + w[:9] + ["y"] + w[:9])]
    _check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_posteriors_equal_brute_force(documents):
    coded = quality.figures(documents).select("doc_id", quality.pattern(quality.F.col("__figures")).alias("code")).collect()
    want = vote_model([r.code for r in coded], len(quality.RULES), quality.START, quality.LEAST)
    got = {r.doc_id: r.good for r in quality.table(documents).collect()}
    assert np.allclose([got[r.doc_id] for r in coded], want, atol=1e-9)


def test_single_faults_are_found_and_good_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.table(docs).join(labels, "doc_id").filter("NOT base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1


def test_no_python_on_executors(documents):
    plan = quality.table(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("votes", [(1,) * 9, (-1,) * 9, (0,) * 9])
def test_codes_hold_the_votes(spark, votes):
    code = sum((v + 1) * 3**i for i, v in enumerate(votes))
    row = spark.range(1).select(*[quality._vote(quality.F.lit(code), i) for i in range(9)]).first()
    assert tuple(row) == votes
