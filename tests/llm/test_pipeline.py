"""The pipeline against a brute-force version, and its stages on odd rows."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from roadpulse.llm import quality
from tests.llm.brute import cut_lines, cut_passages, fingerprint, layout_without, near_groups, vote_model


def _brute(docs, codes):
    """{doc_id: final text} of the first four stages."""
    good = vote_model([codes[i][0] for i in docs], len(quality.RULES), quality.START, quality.LEAST)
    docs = {i: t for (i, t), p in zip(docs.items(), good, strict=True) if p >= 0.5 and not codes[i][1]}
    docs = {i: text for i, (text, _) in cut_lines(list(docs.items()), min_lines=1).items()}
    groups = near_groups({i: fingerprint(t) for i, t in docs.items()})
    docs = {i: t for i, t in docs.items() if groups[i] == i}
    cut = cut_passages(list(docs.items()), 50)
    return {i: t if all(cut[i][1]) else layout_without(t, cut[i][1]) for i, t in docs.items()}


def test_run_equals_brute_force(spark, documents):
    codes = {r.doc_id: (r.code, r.bad) for r in quality.judge(documents).select(
        "__row.doc_id", quality.pattern(quality.F.col("__figures")).alias("code"), quality.F.col("__base_failed").alias("bad")).collect()}
    want = _brute({r.doc_id: r.text for r in documents.orderBy("doc_id").collect()}, codes)
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == lengths[r.doc_id]
    assert got == lengths


def test_stages_keep_the_columns(spark, documents, odd, empty):
    for df in (documents, odd, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            docs = corpus_pipeline.written(out, "test-stage")
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0) == (docs.count() == 0)


def test_columns_of_any_name_pass_through(spark, documents):
    names = ["__row", "__id", "__text", "__words", "__kept", "__gone", "__good", "__h", "__n_removed", "__figures", "__lines", "a.b", "kept", "h", "doc id"]
    docs = documents.limit(60).selectExpr("*", *[f"concat('own ', doc_id) AS `{n}`" for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, "/root/testdata/sf0.001"), "test-names")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"own {r.doc_id}" for r in rows for n in names)
        docs = out


def test_one_of_each_group_stays(spark, odd):
    kept = corpus_pipeline.simhash_near_dedup(spark, odd, "").collect()
    ids = sorted(r.doc_id for r in kept if r.doc_id is not None)
    assert ids == sorted(set(ids)) and 5 in ids and 6 not in ids and 2 not in ids
    assert sum(r.doc_id is None for r in kept) == 2  # rows without an id are never taken for a copy


def test_distinct_texts_under_one_id_stay(spark):
    far = [" ".join(f"{k}word{i}" for i in range(40)) for k in "abc"]
    rows = [(1, far[0]), (2, far[0]), (2, far[1]), (2, far[1]), (3, far[2]), (3, far[1]), (4, None), (None, far[0])]
    kept = corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, far[0]), (2, far[1]), (3, far[2]), (4, ""), (0, far[0])])
    rows = [(7, far[0]), (7, far[1]), (8, far[1])]  # neither is a copy of the other, both have the smallest id
    kept = corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(7, far[0]), (7, far[1])]
