import math
import random
import re

import pytest

from roadpulse.llm import toxicity
from tests.llm.brute import edit_distance


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_edit_distance(seed):
    rng = random.Random(seed)
    word = lambda a, b: "".join(rng.choice("abc") for _ in range(rng.randint(a, b)))
    terms = {word(3, 8): rng.randint(0, 2) for _ in range(8)} | {word(3, 5) + "*": rng.randint(0, 1) for _ in range(3)}
    machine = toxicity.Automaton(terms)
    for _ in range(1500):
        w = word(0, 10)
        near = [d for t, k in terms.items() if not t.endswith("*") and (d := edit_distance(t, w)) <= k]
        near += [d for t, k in terms.items() if t.endswith("*") and (d := min(edit_distance(t[:-1], w[:n]) for n in range(len(w) + 1))) <= k]
        assert machine.edits(w) == min(near, default=-1), (terms, w)


def test_quotations_are_told_from_abuse():
    scan = toxicity.Scanner({"stupid": 1, "idiot": 1})
    said = scan.hits('the word "stupid" is often quoted')
    assert [(h[1], h[2]) for h in said] == [(0, True)]
    meant = scan.hits("you stupid idot go away")
    assert [(h[0], h[1], h[2], h[3]) for h in meant] == [(1, 0, False, 1), (2, 1, False, 1)]
    assert scan.hits("") == [] and scan.hits("nothing here") == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.score(docs, labels).filter("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").collect()
    toxic, clean = ([r for r in rows if r.toxic == k] for k in (1, 0))
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_misspelled_terms_count(spark):
    terms = {"worthless": 2, "clown": 1}
    rows = [(i, f"a calm and friendly text about the weather on day{i}", 0) for i in range(40)] + \
           [(100 + i, f"a text that calls him a {w} again on day{i}", 1) for i, w in enumerate(["worthless", "wortless", "worthles", "clown", "clwn", "clowwn"] * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df.select("doc_id", "text"), df.select("doc_id", "toxic"), terms=terms).collect()}
    assert all(got[i].predicted == t for i, _, t in rows)
    assert got[101].misspelled == 1 and got[101].exact == 0 and got[101].spans[0].first == 6


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (5, 1), (6, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.score(odd, labels.filter("false"), terms={"short": 1}).filter("predicted = 1").count() == 3
    assert toxicity.score(odd, labels.filter("false")).filter("predicted = 1").count() == 0


@pytest.mark.parametrize("clean_copies", [0, 6])  # sure words and stems; those that hint
def test_misspellings_of_learned_families(spark, clean_copies):
    words = ["blarghen", "blargher", "blarghes", "blarghish", "blarghous"]
    rows = [(int(n < 9), f"some {w} in text {n} of them") for w in words for n in range(9 + clean_copies)]
    rows += [(0, f"some quiet text in which nobody said any of them {n}") for n in range(200)]
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "y int, text string"))
    assert any(t.endswith("*") for t in terms) and set(words) <= set(terms)
    scan = toxicity.Scanner(terms)
    for w in ["blarghen", "blrghen", "blagher", "blurghish", "blaarghous", "blxrghate"]:  # the last by the stem alone
        hits, hints, _ = scan.scan(f"you {w} there")
        odd = w not in words
        if clean_copies:
            assert not hits and hints == (int(not odd), int(odd)), w
        else:
            assert [h[1] > 0 for h in hits] == [odd], w
    assert scan.scan("you quiet there")[:2] == ([], (0, 0))


@pytest.mark.parametrize("text", ["idiot/moron", "you...idiot", "_idiot_", "go,you:idiot!now", "私は(idiot)です"])
def test_terms_joined_by_punctuation(text):
    scan = toxicity.Scanner({"idiot": 1, "moron": 1})
    assert [h[:3] for h in scan.hits(text)] == [(0, 0, False)] * (2 if "moron" in text else 1)


def test_quotation_marks_in_text_without_spaces():
    scan = toxicity.Scanner({"idiot": 0, "moron": 0})
    assert [h[2] for h in scan.hits("he_said:“idiot”,moron")] == [True, False]


def test_terms_in_any_number(spark):
    words = [f"bad{i:04d}" for i in range(3500)]
    rows = [(1, " ".join(words)) for _ in range(9)] + [(0, f"a calm text of day {i}") for i in range(30)]
    rows = [(y, f"{t} number {i}") for i, (y, t) in enumerate(rows)]
    assert set(words) <= set(toxicity.learn_terms(spark.createDataFrame(rows, "y int, text string")))


def _plain_figures(text, terms, window=12):
    """The figures by an edit distance to every term, word by word."""
    def fewest(word, own):
        near = [d for t, k in own.items() if not t.endswith("*") and (d := edit_distance(t, word)) <= k]
        near += [d for t, k in own.items() if t.endswith("*") and (d := min(edit_distance(t[:-1], word[:n]) for n in range(len(word) + 1))) <= k]
        return min(near, default=-1)

    sure = {t: k for t, k in terms.items() if k >= 0}
    hints = {t: -1 - k for t, k in terms.items() if k < 0}
    hits, exact, odd, marks = [], 0, 0, []
    split = text.lower().split()
    for at, raw in enumerate(split):
        marks += [(at, i) for i, c in enumerate(raw) if c in "\"“”«»„"]
        for m in re.finditer(r"[^\W_]+", raw):
            edits = fewest(m[0], sure)
            hint = fewest(m[0], hints) if edits < 0 else -1
            exact, odd = exact + (hint == 0), odd + (hint > 0)
            if edits >= 0:
                hits.append((at, m.start(), edits))
    n = max(len(split), 20)
    hinted = [math.log1p(exact), math.log1p(100 * exact / n), math.log1p(odd)]
    if not hits:
        return [0.0] * 7 + hinted
    quoted = near = 0
    for at, place, _ in hits:
        left, right = [m for m in marks if m < (at, place)], [m for m in marks if m >= (at, place)]
        quoted += bool(left and right and at - left[-1][0] <= window and right[0][0] - at <= window)
        near = max(near, sum(abs(h[0] - at) <= window for h in hits) - 1)
    wrong = sum(h[2] > 0 for h in hits)
    return [1.0, math.log1p(len(hits)), math.log1p(wrong), float(wrong == len(hits)), math.log1p(quoted), float(quoted == len(hits)),
            math.log1p(near), *hinted]


def test_scores_equal_a_plain_version(spark):
    rng = random.Random(4)
    terms = {"worthless": 2, "clown": 1, "scum*": 1, "silly": -1, "dimwit": -2}
    pool = ["worthless", "wortless", "clown", "clwn", "scumbag", "scm", "silly", "sily", "dimwt", "calm", "weather", "report", "\"he", "said\"", "(clown)", "a/clown"]
    rows = []
    for i in range(300):
        y = i % 2
        text = " ".join(rng.choice(pool if y and rng.random() < 0.7 else pool[9:14]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.score(df.select("doc_id", "text"), df.select("doc_id", "toxic"), terms=terms).collect()
    texts = {i: t for i, t, _ in rows}
    seen = {i: _plain_figures(t, terms) for i, t, _ in rows}
    train = {(t, y) for i, t, y in rows if not next(r for r in out if r.doc_id == i).held_out}  # equal rows count once
    weights = toxicity.fit_weights(toxicity.np.array([_plain_figures(t, terms) for t, _ in sorted(train)]), toxicity.np.array([float(y) for _, y in sorted(train)]))
    for r in out:
        scan = toxicity.Scanner(terms)
        assert scan.figures(*scan.scan(texts[r.doc_id])) == pytest.approx(seen[r.doc_id])
        z = sum(w * x for w, x in zip(weights, [*seen[r.doc_id], 1.0], strict=True))
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-6)
