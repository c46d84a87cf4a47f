import random

import numpy as np

from roadpulse.llm import licenses


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {(r.doc_id, name) for r in docs.collect() for name, t in licenses.TEMPLATES.items()
            if f" {' '.join(licenses.template_words(t))} " in f" {' '.join(licenses.template_words(r.text))} "}
    rows = licenses.scan(docs).collect()
    assert want and want == {(r.doc_id, r.license) for r in rows if r.coverage == 1.0}
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        found = licenses.template_words(text[r.doc_id][r.first_char:r.end_char])
        assert len(found) == r.n_words and (r.edits or found == licenses.template_words(licenses.TEMPLATES[r.license]))


def test_altered_copies(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for i, name in enumerate(["MIT", "Apache-2.0 header", "GPL-3.0 header", "ISC"] * 5):
        w = licenses.TEMPLATES[name].split()
        for _ in range(len(w) // 15):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["other"], [w[at], "more"]])
        around = " ".join(f"x{rng.randrange(99)}" for _ in range(rng.randrange(200)))
        rows.append((i, f"{around}\n{' '.join(w)}\n{around}"))
        want.add((i, name))
    rows += [(100, licenses.TEMPLATES["MIT"][:200]), (101, "the software is provided free of charge to any person")]
    got = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want <= got and not any(i in (100, 101) for i, _ in got)


def _edits(term, text):
    """Fewest edits of `term` against any stretch of `text`."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(term, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(1)
    index = licenses.TemplateIndex({"t": "a b c d e f g h i j k l a b c"})
    for _ in range(200):
        text = rng.integers(-1, len(index.number), rng.integers(3, 40))
        at = int(rng.integers(0, len(text)))
        own = index.ids[0].copy()
        own[rng.integers(0, len(own), 2)] = -1
        text = np.concatenate([text[:at], own, text[at:]])
        wide = len(text) + len(own)
        edits, matched, first, end = index.align(0, text, at, at, wide)
        assert edits == _edits(index.ids[0].tolist(), text.tolist())
        assert matched <= end - first and matched >= len(own) - edits
        narrow = index.align(0, text, at, at, 3)
        assert narrow[0] <= 2


def test_odd_rows(spark, odd, empty):
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0
    docs = spark.createDataFrame([(None, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "Released under the MIT License."),
                                  (2, "İ Released under the MIT License."), (3, "Released under the MIT License. Released under the MIT license")],
                                 "doc_id long, text string")
    rows = licenses.scan(docs).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1, 2, 3, 3]
    assert {(r.doc_id, r.first_char, r.end_char) for r in rows if r.doc_id in (None, 2)} == {(None, 0, 30), (2, 2, 32)}


def test_spans_where_lower_case_is_longer():
    for text in ("İ İstanbul MIT İ. License", "plain WORDS here", "ΣΑΣ Σ İx", ""):
        found = [text[a:b] for a, b in licenses.spans(text)]
        assert [licenses.template_words(x) for x in found] == [[w] for w in licenses.template_words(text)]


def _covered(template, text, coverage):
    """Whether some stretch of `text`, aligned with the whole of `template` by fewest edits, matches enough of it."""
    best = [(0, 0)] * (len(text) + 1)  # (edits, -matched) of the template so far against a stretch that ends here
    for i, x in enumerate(template, 1):
        new = [(i, 0)]
        for j, y in enumerate(text, 1):
            (e, m), (e2, m2), (e3, m3) = best[j - 1], best[j], new[-1]
            new.append(min((e, m - 1) if x == y else (e + 1, m), (e2 + 1, m2), (e3 + 1, m3)))
        best = new
    return -min(best)[1] >= coverage * len(template)


def test_scan_equals_full_alignment_of_every_template(spark):
    rng = random.Random(11)
    names = sorted(licenses.TEMPLATES)
    texts = []
    for i in range(40):
        words = licenses.template_words(licenses.TEMPLATES[names[i % len(names)]])[:60]
        for _ in range(rng.randrange(1 + len(words) // 3)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
        around = [f"x{rng.randrange(30)}" for _ in range(rng.randrange(30))]
        texts.append(" ".join(around + words + around))
    texts += [r.text[:600] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    got = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = {(i, n) for i, t in enumerate(texts) for n in names
            if _covered(licenses.template_words(licenses.TEMPLATES[n]), licenses.template_words(t), 0.8)}
    assert want and got >= want and all(_near(n, texts[i]) for i, n in got - want)


def _near(name, text):
    """A copy the operator alone reports: the words of the template are there in number."""
    own = licenses.template_words(licenses.TEMPLATES[name])
    return sum(w in set(licenses.template_words(text)) for w in own) >= 0.8 * len(own)


def test_one_word_changes_of_short_notices(spark):
    rows, want = [], set()
    for name, text in licenses.TEMPLATES.items():
        w = licenses.template_words(text)
        if len(w) > 13:
            continue
        for at in range(len(w)):
            for new in ([], ["other"], [w[at], "more"]):
                rows.append((len(rows), f"a b c {' '.join(w[:at] + new + w[at + 1:])} d e f"))
                want.add((rows[-1][0], name))
    got = [(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert want <= set(got) and len(got) == len(set(got))  # each once


def test_changes_up_to_the_coverage(spark):
    rows = []
    for name, text in licenses.TEMPLATES.items():  # every fifth word: no shingle is sure to be chosen
        w = licenses.template_words(text)
        rows.append((name, " ".join("other" if i % 5 == 4 else x for i, x in enumerate(w))))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)] + [(99, "mit license")], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    assert {(i, name) for i, (name, _) in enumerate(rows)} <= got
