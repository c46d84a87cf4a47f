"""Removal of word passages that repeat across documents, by level-wise doubling of windows.

The first level takes windows of half the length. Of each full window's halves-sized windows the
one with the smallest hash stands for it, so few have to be compared, equal full windows choose
alike, and a full window can only repeat if its choice does. Choices found in one document only
die; the windows whose choice repeats alone are extended to twice that length. At the full length a
window dies unless a document with a smaller id holds it too; what the remaining ones cover goes.
No longer level is needed: a longer repeat is covered by its full windows.

Rows meet by window hash (64 bits, from a doubling of word hashes). What one batch can settle
by itself is settled there: of a window that several of its documents share, only the smallest and
largest id go on to the shuffle, so a passage that a third of all documents hold makes a few rows a
batch, never one task's load.

A null text has no words. A null id takes no part: such rows stay whole. Rows equal in id and text
are one document and are cut alike; rows equal in id alone never cut each other. Texts are
read whole, an empty table gives an empty result, further columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import apart, words, written

_KEY = ["__id", "__text"]
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * _A) ^ (right + _B + (left << np.uint64(6)))
    x ^= x >> np.uint64(29)
    x *= _B
    return x ^ (x >> np.uint64(32))


def windows(hashed: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of `length` words, by doubling from single words."""
    found, n = hashed, 1
    while n < length:
        step = min(n, length - n)
        found = _joined(found[:-step], found[step:]) if len(found) > step else found[:0]
        n += step
    return found


def _hashed(text: str | None) -> np.ndarray:
    split = (text or "").encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))


def _choices(hashed: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Half-length windows, and for each full window the place of the one that stands for it."""
    half = length // 2
    small = windows(hashed, half)
    strip = np.lib.stride_tricks.sliding_window_view(small, length - half + 1)
    return small, strip.argmin(axis=1) + np.arange(len(strip))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__text", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))


_ROWS = pa.schema([("w", pa.int64()), ("__id", pa.int64()), ("__text", pa.int64()), ("at", pa.int32()), ("sure", pa.list_(pa.int64()))])
_ROWS_DDL = "w long, __id long, __text long, at int, sure array<long>"


def _settled(w: np.ndarray, doc: np.ndarray, at: np.ndarray, ids: np.ndarray, texts: np.ndarray, later: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a batch for the comparison by window. w, doc (row number), at: the windows. later:
    only a smaller id settles a window, else any other id does. `sure` holds what is settled:
    places if later, else windows; such a row meets no other."""
    order = np.lexsort((ids[doc], w))
    w, doc, at = w[order], doc[order], at[order]
    own = ids[doc]
    starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(w)))
    least, most = np.repeat(own[starts], sizes), np.repeat(own[starts + sizes - 1], sizes)
    done = own > least if later else least < most
    ends = np.zeros(len(w), bool)
    ends[starts] = True
    if not later:
        ends[starts + sizes - 1] = True
    open_ = ends | ~done
    if open_.any():
        d = doc[open_]
        yield pa.RecordBatch.from_arrays([pa.array(w[open_].view(np.int64)), pa.array(ids[d]), pa.array(texts[d]), pa.array(at[open_].astype(np.int32)),
                                          pa.nulls(len(d), _ROWS.field("sure").type)], schema=_ROWS)
    if done.any():
        d, value = doc[done], (at[done] if later else w[done].view(np.int64)).astype(np.int64)
        order = np.argsort(d, kind="stable")
        d, value = d[order], value[order]
        starts = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(d)).astype(np.int32)), pa.array(value))
        one = d[starts]
        yield pa.RecordBatch.from_arrays([pa.array(ids[one] * 2 + 1 ^ texts[one]), pa.array(ids[one]), pa.array(texts[one]), pa.array(np.zeros(len(one), np.int32)), lists],
                                         schema=_ROWS)


def _first_level(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            w, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                hashed = _hashed(text)
                if len(hashed) >= length:
                    small, place = _choices(hashed, length)
                    w.append(np.unique(small[np.unique(place)]))
                    doc.append(np.full(len(w[-1]), i))
            w, doc = np.concatenate(w), np.concatenate(doc)
            yield from _settled(w, doc, np.zeros(len(w), np.int64), ids, texts, False)
    return run


def _second_level(length: int, most: int = 1 << 19):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            w, doc, at, held = [], [], [], 0
            for i, (text, alive) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                hashed = _hashed(text)
                small, place = _choices(hashed, length)
                live = np.flatnonzero(np.isin(small[place], np.array(alive, np.int64).view(np.uint64)))
                w.append(windows(hashed, length)[live])
                doc.append(np.full(len(live), i))
                at.append(live)
                held += len(live)
                if held >= most:
                    yield from _settled(np.concatenate(w), np.concatenate(doc), np.concatenate(at), ids, texts, True)
                    w, doc, at, held = [], [], [], 0
            if held:
                yield from _settled(np.concatenate(w), np.concatenate(doc), np.concatenate(at), ids, texts, True)
    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_removed, digest, texts = [], [], []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                spans = [m.span() for m in _WORD.finditer(text)]
                edge = np.zeros(len(spans) + 1, np.int64)
                starts = np.unique(np.array(starts, np.int64))
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = [text[a:b] for (a, b), g in zip(spans, gone.tolist(), strict=True) if not g]
                n_removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(" ".join(kept).encode()).hexdigest())
                turns = np.flatnonzero(np.diff(np.concatenate([[1], gone.astype(np.int8), [1]])))
                pieces = [text[spans[a][0]:spans[b - 1][1]] for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
                texts.append("\n".join(pieces))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
                                              pa.array(texts, pa.string())], names=[*_KEY, "__n_removed", "__digest", "__kept"])
    return run


def cuts(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __text (hash), __n_removed, __digest (of the kept words, joined by a space), __kept (the
    text with the kept words in their own layout) of the documents that lose words."""
    if length < 2 or length % 2:
        raise ValueError("the length must be even")
    own = _keyed(docs.select(id_col, text_col), id_col, text_col).filter("__id IS NOT NULL").select(*_KEY, F.col(text_col).alias("text"))
    by_window = W.partitionBy("w")
    small = own.mapInArrow(_first_level(length), _ROWS_DDL).withColumn("least", F.min("__id").over(by_window)).withColumn("most", F.max("__id").over(by_window))
    alive = (small.filter("sure IS NOT NULL OR least < most").select(*_KEY, F.coalesce("sure", F.array("w")).alias("w"))
             .groupBy(*_KEY).agg(F.flatten(F.collect_list("w")).alias("alive")))
    live = written(own.join(alive, _KEY), "passages")
    large = live.mapInArrow(_second_level(length), _ROWS_DDL).withColumn("least", F.min("__id").over(by_window))
    gone = (large.filter("sure IS NOT NULL OR least < __id").select(*_KEY, F.coalesce("sure", F.array(F.col("at").cast("long"))).alias("at"))
            .groupBy(*_KEY).agg(F.flatten(F.collect_list("at")).alias("at")))
    return (live.select(*_KEY, "text").join(gone, _KEY)
            .mapInArrow(_cut(length), "__id long, __text long, __n_removed long, __digest string, __kept string").dropDuplicates(_KEY))


def table(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = words(F.col("text"))
    base = _keyed(own, "doc_id", "text").select("doc_id", *_KEY, F.size(split).cast("long").alias("n_words"), F.sha2(F.array_join(split, " "), 256).alias("whole"))
    found = cuts(own, length).drop("__kept")
    return base.join(found, _KEY, "left").select("doc_id", "n_words", F.coalesce("__n_removed", F.lit(0)).cast("long").alias("n_removed"),
                                                 F.coalesce("__digest", "whole").alias("kept_sha256"))


def cut(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`__row` (the row of `docs`), `__kept` (the text without repeated passages), `__n_removed`."""
    docs, id_col, text_col = apart(docs, doc_id=id_col, text=text_col), "doc_id", "text"
    found = cuts(docs, length, id_col=id_col, text_col=text_col).drop("__digest")
    return (_keyed(docs, id_col, text_col).join(found, _KEY, "left")
            .select("__row", F.coalesce("__kept", F.col(text_col)).alias("__kept"), F.coalesce("__n_removed", F.lit(0)).alias("__n_removed")))
