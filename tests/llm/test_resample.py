import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from roadpulse.llm.resample import counts, draw, gains, hashes, pieces, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text, length=2):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return [" ".join(words[i:i + n]) for n in range(1, length + 1) for i in range(len(words) - n + 1)], len(words)


def _brute(docs, target, percent=25, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    count = lambda texts: Counter(bucket(f) for t in texts for f in _features(t)[0])
    s, t = count(x for _, x in docs), count(target)
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        found, n_words = _features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for r in rows:
        r[4] = None
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def _rows(found):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("length", [1, 2, 3, 5])
@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_chained_hashes_in_pieces(monkeypatch, length, size):
    text = "The quick, BROWN fox – ÉTÉ été 日本語 x_y-z 007 jumps\n\nover  it. " * 3
    monkeypatch.setattr("roadpulse.llm.resample.pieces", lambda t: pieces(t, size))
    got = sorted(h for found in hashes(text, length) for h in found)
    assert got == sorted(zlib.crc32(f.encode()) for f in _features(text, length)[0])


def test_whole_table(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert _rows(resample(documents, target)) == _brute(docs, [r.text for r in target.collect()])


def test_odd_rows(spark, odd, empty):
    target = spark.createDataFrame([(1, "word1x1 word2x2 the same"), (2, None)], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    found = resample(odd, target, percent=70)
    assert _rows(found) == _brute(docs, [r.text for r in target.collect()], percent=70)
    drawn = draw(odd, target, percent=70)
    assert drawn.columns == odd.columns and drawn.count() == found.filter("rank IS NOT NULL").count() > 0
    assert resample(empty, target).count() == 0
    assert _rows(resample(odd, target.filter("false"))) == _brute(docs, [])


def test_a_third_of_all_rows_alike(spark):
    same = "a text of more than twenty words that a third of all rows repeat without an id of their own so that nothing tells them apart"
    rows = [(None, same)] * 200 + [(i, f"{same} {i} {i % 7}") for i in range(400)]
    target = spark.createDataFrame([(same,)], "text string")
    found = resample(spark.createDataFrame(rows, "doc_id long, text string"), target, percent=90)
    assert _rows(found) == _brute(rows, [same], percent=90)


def test_the_draw_moves_towards_the_target(spark):
    rng = np.random.default_rng(3)
    near, far = [f"alpha{i}" for i in range(50)], [f"omega{i}" for i in range(50)]
    text = lambda words: " ".join(rng.choice(words, 30))
    docs = spark.createDataFrame([(i, text(near if i % 5 == 0 else far)) for i in range(500)], "doc_id long, text string")
    target = spark.createDataFrame([(text(near),) for _ in range(40)], "text string")
    drawn = [r.doc_id for r in draw(docs, target, percent=20).collect()]
    assert len(drawn) == 100 and sum(i % 5 == 0 for i in drawn) > 60  # 20 of 100 without weights
    gain = gains(counts(docs), counts(target))
    assert gain[zlib.crc32(b"alpha1") % 10_000] > 0 > gain[zlib.crc32(b"omega1") % 10_000]


def test_names_used_inside_pass_through(spark):
    names = ["row", "n_features", "weight", "score", "rank", "part", "at", "tie", "before", "n_words", "a.b", "__text"]
    docs = spark.createDataFrame([(i, f"some words of text number {i} " * 6, *["own"] * len(names)) for i in range(20)],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    drawn = draw(docs, docs.limit(3), percent=50)
    assert drawn.columns == docs.columns and drawn.count() == 10
    assert {tuple(r)[2:] for r in drawn.collect()} == {("own",) * len(names)}
