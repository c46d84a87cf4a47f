import hashlib
import re
import time
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import personal as P

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def _passes(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == 1:
        return all(int(x) <= 255 for x in found.split("."))
    if kind == 2:
        doubled = [d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def _base(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if _passes(k, m[0]))


def _listed(spans):
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "255", "4111 1111 1111 1111", "4845168114407329", ".", "-", " ", "@", "a", "b.c", "+", "(", ")", "é", "\n",
                                 "+1 (826) 555-4081", "10.0.0.1", "x@y.z", "%", "00000000000000000255"]), max_size=14).map("".join))
def test_patterns_equal_plain_ones(text):
    assert P.matches(text)[0] == _base(text)


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "1." * 200_000, "+1" + " " * 300_000, "a@b" * 100_000, "1 " * 200_000,
                                  "x@y.z " * 50_000])
def test_patterns_take_linear_time(text):
    begun = time.perf_counter()
    P.matches(text)
    assert time.perf_counter() - begun < 5


def _paths(steps):
    for path in product(range(P.N_TAGS), repeat=steps):
        if P._START[path[0]] and all(P._ALLOWED[a, b] for a, b in zip(path, path[1:], strict=False)):
            yield path


def test_a_further_character_follows_its_own_kind():
    for a, b in product(range(P.N_TAGS), repeat=2):
        assert P._ALLOWED[a, b] == (b == 0 or b % 2 == 1 or a in (b, b - 1))


def test_posteriors_and_gradient_against_all_paths():
    model = P.Tagger(embed=3, hidden=2)
    rng = np.random.default_rng(0)
    model.p["trans"], model.p["start"] = (rng.normal(size=model.p[k].shape).astype(np.float32) for k in ("trans", "start"))
    ids, tags = rng.integers(1, 90, (4, 2)).astype(np.int16), np.array([[0, 1], [3, 2], [4, 2], [0, 0]])
    valid = np.array([[True, True], [True, True], [True, True], [True, False]])

    def loss():
        total, marginals = 0.0, []
        score = model._score(ids)[0].astype(float)
        for j in range(2):
            steps = int(valid[:, j].sum())
            weigh = lambda p: np.exp(model.p["start"][p[0]] + sum(score[t, j, p[t]] for t in range(steps)) + sum(model.p["trans"][a, b] for a, b in zip(p, p[1:], strict=False)))  # noqa: E731, B023
            weights = {p: weigh(p) for p in _paths(steps)}
            marginals.append([[sum(w for p, w in weights.items() if p[t] == k) / sum(weights.values()) for k in range(P.N_TAGS)] for t in range(steps)])
            total -= np.log(weigh(tuple(tags[:steps, j])) / sum(weights.values())) / 2
        return total, marginals

    _, marginals = loss()
    post = model.posteriors(ids, valid)
    for j, m in enumerate(marginals):
        assert np.allclose(post[:len(m), j], m, atol=1e-4)
    grad = model.gradient(ids, tags, valid)
    for name, g in grad.items():
        for at in rng.choice(g.size, min(5, g.size), replace=False):
            place = np.unravel_index(int(np.argmax(np.abs(g))) if at % 2 else int(at), g.shape)
            old = model.p[name][place]
            model.p[name][place] = old + 1e-2
            up = loss()[0]
            model.p[name][place] = old - 1e-2
            down = loss()[0]
            model.p[name][place] = old
            assert abs((up - down) / 2e-2 - g[place]) < 5e-3, name


def test_best_paths_against_all_paths():
    rng = np.random.default_rng(4)
    posts = [rng.dirichlet(np.ones(P.N_TAGS) / 3, n).astype(np.float32) for n in (1, 4, 2, 4, 3)]
    for post, got in zip(posts, P.best_paths(posts), strict=True):
        scored = {p: sum(np.log(post[t, k] + 1e-9) for t, k in enumerate(p)) for p in _paths(len(post))}
        assert abs(scored[tuple(map(int, got))] - max(scored.values())) < 1e-4


def test_windows_cover_stretches():
    for n in (1, 95, 96, 97, 143, 144, 145, 500):
        found = P.windows(7, 7 + n, 96)
        assert {i for a, b in found for i in range(a, b)} == set(range(7, 7 + n)) and all(0 < b - a <= 96 for a, b in found)
    text = "plain words " * 40 + "call 555-1234 now " + "more words " * 40 + "a@b"
    ids, space, signal = P.symbols(text)
    found = P.stretches(space, signal, 24)
    held = {i for a, b in found for i in range(a, b)}
    assert {i for i, c in enumerate(text) if c.isdigit() or c == "@"} <= held and len(held) < 150


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def tagger(corpus):
    return P.fit(corpus.filter("crc32(cast(doc_id as string)) % 5 <> 0"))


def test_held_out_spans(corpus, tagger):
    """The tagger alone, on texts it was not trained on, against what the patterns find there."""
    texts = [r.text for r in corpus.filter("crc32(cast(doc_id as string)) % 5 = 0 AND text rlike '[0-9@]'").collect()]
    want = [set(_base(t)) for t in texts]
    got = [set(x) for x in P.tagged(tagger, texts)]
    caught, all_want, extra = sum(len(a & b) for a, b in zip(want, got, strict=True)), sum(map(len, want)), sum(len(b - a) for a, b in zip(want, got, strict=True))
    assert all_want > 100 and caught >= 0.95 * all_want and extra <= 0.03 * all_want


def test_spans_the_patterns_miss(tagger):
    texts = ["please call +1 (826) 555-4081 190.137.223.20 or write", "two cards 7536784127813050 4845168114407329 lie here",
             "the address is josé.müller@mail7.example.com as before", "a token = \"9b0b3c6a43eb78aa99cbd7049c572391\" is no number",
             "Licensed under the Apache License, Version 2.0.", "plain words and nothing else " * 20]
    found = [{(P.KINDS[k], t[s:e]) for s, k, e in own} for t, own in zip(texts, P.tagged(tagger, texts), strict=True)]
    assert ("phone", "+1 (826) 555-4081") in found[0] and ("ip", "190.137.223.20") in found[0]
    assert ("card", "4845168114407329") in found[1]
    assert found[3:] == [set(), set(), set()]


def test_a_stretch_of_many_windows(tagger):
    text = "numbers " + " ".join(f"{i} 97.51.17.{i % 256} +1 (826) 555-{4000 + i}" for i in range(2000)) + " end"
    base = set(P.matches(text)[0])
    got = set(P.tagged(tagger, [text])[0])
    ips = {s for s in base if s[1] == 1}
    assert len(got & ips) > 0.9 * len(ips) > 0


def test_rows(spark, tagger, odd, empty):
    extra = spark.createDataFrame([(50, "mail me at someone@mail3.example.com, 10.20.30.40 or +1 (344) 555-1234, card 4845168114407329 thanks"),
                                   (51, "two cards 4845168114407320 4845168114407329 lie here"), (51, "999.1.1.1 and 1.1.1.1.1")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra)
    rows = P.find(docs.selectExpr("*", "1 AS spans", "2 AS `a.b`"), tagger).collect()
    assert len(rows) == docs.count()
    given = {}
    for r in docs.collect():
        given.setdefault(r.doc_id, []).append(_base(r.text))
    for r in rows:
        base = next(b for b in given[r.doc_id] if hashlib.sha256(_listed(b).encode()).hexdigest() == r.base_sha256)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert {x for x in _listed(base).split(",") if x} <= set(r.spans.split(",")) and r.n_added == len([x for x in r.spans.split(",") if x]) - len(base)
    assert next(r for r in rows if r.doc_id == 50).spans.count(":") == 8
    assert P.scan(empty).count() == 0
    assert {r.n_added for r in P.scan(odd).collect()} == {0}  # nothing to train on


def test_the_query_is_the_same_each_time(corpus, tagger):
    again = P.fit(corpus.filter("crc32(cast(doc_id as string)) % 5 <> 0").repartition(5))
    assert all(np.allclose(tagger.p[k], again.p[k], atol=1e-3) for k in tagger.p)
