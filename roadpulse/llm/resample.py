"""Importance resampling towards a target distribution, over hashed word n-grams.

A text's bytes go through a 256-byte table that lower-cases A-Z and blanks everything that is no
letter, digit or byte of a non-ASCII character; `bytes.split` gives the words. A run of words is
hashed by chained crc32: the checksum of the run one word shorter seeds the next, so an n-gram is
never joined. The checksum modulo `buckets` is the feature. Tasks count their features in a
Counter and hand on one row per bucket; the sums over the documents and over the target texts give
each bucket a gain, the logarithm of the two smoothed shares' quotient. A document's weight is its
features' mean gain, its score the weight plus Gumbel noise drawn from its id, and the highest
scores are a sample without replacement in proportion to exp(weight).

The ranks are global and no task sees all rows: rows are dealt out by ranges of the score, numbered
within their range, and the ranges' sizes (one number per partition) give the offsets.

Null texts count as empty: no features, weight 0. A null id draws its noise from an empty id and
ranks behind other ids of its score; repeated rows are ranked one by one. A long text is read in
pieces of a megabyte. Empty tables give empty results, an empty target gives every bucket the
same numerator. `draw` returns the input's own rows with all their columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import written

#: A-Z to lower case; a-z, 0-9 and all bytes of non-ASCII characters stay; the rest becomes a space
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def pieces(text: str, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of `text`, in lists of about `size` bytes."""
    data, at = text.encode().translate(TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def hashes(text: str, length: int = 2) -> Iterator[list[int]]:
    """crc32 of every run of 1 to `length` words, in lists; those of single words are every `length`th."""
    before: list[list[int]] = [[]] * length  # for each length the checksum that ends the last piece
    for words in pieces(text):
        spaced = [b" " + w for w in words]
        runs: list[list[int]] = []
        for k in range(length):
            if k == 0:
                runs.append(list(map(crc32, words)))
            else:  # a run of k + 1 words is seeded by the run of k words that ends one word earlier
                seeds = (before[k - 1] + runs[k - 1])[:-1]
                runs.append(list(map(crc32, spaced[len(words) - len(seeds):], seeds)) if seeds else [])
            yield runs[k]
        before = [(old + new)[-1:] for old, new in zip(before, runs, strict=True)]


def counts(texts: DataFrame, text_col: str = "text", *, length: int = 2, buckets: int = 10_000) -> dict[int, int]:
    """Features per bucket over all rows; the driver gets at most `buckets` sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for found in hashes(text.as_py(), length):
                    seen.update((np.array(found, np.uint32) % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["bucket", "n"])

    each = texts.select(F.col(text_col).alias("text")).filter("text IS NOT NULL").mapInArrow(run, "bucket int, n long")
    return {r.bucket: r.n for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = 10_000) -> np.ndarray:
    """Thousandths of the logarithm of the target's share of a bucket over the source's."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * all_source / (float(source.get(b, 0) + 1) * all_target)))
                     for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: int = 7) -> int:
    """Gumbel noise in thousandths, from the seed and the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, *, length: int = 2, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
           whole: bool = False) -> DataFrame:
    """doc_id, n_features, weight, score, n_words of every row, and, if `whole`, the row itself."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n = total = words = 0
                for i, found in enumerate(hashes(text.as_py() or "", length)):
                    n += len(found)
                    words += len(found) if i % length == 0 else 0
                    total += int(gain[np.array(found, np.uint32) % buckets].sum())
                weight = total // n if n else 0
                out.append((n, weight, weight + noise(doc_id, seed), words))
            figures = np.array(out, np.int64).reshape(len(out), 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, figures.T), *batch.columns[2:]], names=schema.names)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.struct("*").alias("row")] if whole else []))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_features", "weight", "score", "n_words")]
                          + [f for f in own.schema.fields if f.name == "row"])
    return own.mapInArrow(run, schema)


def ranked(rows: DataFrame, percent: int = 25, least_words: int = 20) -> DataFrame:
    """`rows` (as `scored` gives them) with rank: 1, 2, 3... by score for the drawn `percent` of the
    rows with `least_words` words, null for all others."""
    spark = rows.sparkSession
    able = F.col("n_words") >= least_words
    drawn = percent * rows.filter(able).count() // 100
    # the row number spreads what is alike in everything else, such as repeated rows without an id
    numbered = written(rows.withColumn("tie", F.monotonically_increasing_id()), "resample-scores")
    order = [F.desc(able), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("tie")]
    laid = written(numbered.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
                   "resample-order")
    part, place = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per partition
    offsets = [(r.part, before) for r, before in zip(sizes, accumulate((r.n for r in sizes), initial=0), strict=False)]
    ranges = spark.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + place + 1
    return (laid.withColumn("part", part).join(F.broadcast(ranges), "part")
            .withColumn("rank", F.when(able & (rank <= drawn), rank)).drop("part", "at", "tie", "before"))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, least_words: int = 20, length: int = 2, buckets: int = 10_000,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", whole: bool = False) -> DataFrame:
    """doc_id, n_features, weight, score, n_words, rank (null: not drawn) of every row."""
    gain = gains(counts(docs, text_col, length=length, buckets=buckets), counts(target, target_col, length=length, buckets=buckets), buckets)
    rows = written(scored(docs, gain, length=length, seed=seed, id_col=id_col, text_col=text_col, whole=whole), "resample-rows")
    return ranked(rows, percent, least_words)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of `docs`, with their own columns."""
    return resample(docs, target, whole=True, **options).filter("rank IS NOT NULL").select("row.*")
