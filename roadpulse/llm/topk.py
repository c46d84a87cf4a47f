"""Exact top-k inner-product search on a bit-sliced index.

Every vector component x becomes the integer floor(scale * x). A block of vectors is kept as
bit slices: one bitmap over the block's rows per dimension and bit. A query's scores are
added up as bitmaps: each set bit of a query component adds the dimension's slices, shifted, into
a carry-save pair of slice stacks, so all rows of the block are scored by bitwise operations. The
top k rows are then selected from the most significant slice downward, and rows tied at the
boundary are settled by the smaller id.

Vectors that are null or hold null or non-finite components take no part; vectors meet only
vectors of their own length. Components of more than 40 bits (any finite number) are Python
integers, sliced like the others; a score beyond a long takes its true place and is given as the
nearest long. A row with a null id takes part as a candidate after all other ids and never as a
query. Repeated rows are ranked one by one, an empty table gives an empty result, further
columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import written

_LAST_ID = np.iinfo(np.int64).max
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.int32()), ("big", pa.string())])
_COMPLEMENT = str.maketrans("0123456789", "9876543210")


def quantised(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """vec_id, q (array of long), x of the vectors that take part; where a component needs more than 40
    bits, q is null and x holds the components as they are."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    small = F.forall(x, lambda v: F.abs(v) < 2.0**39 / scale)
    return (table.filter(F.col(vector_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.when(small, F.transform(x, lambda v: F.floor(v * scale))).alias("q"),
                    F.when(~small, x).alias("x")))


def _values(q: pa.Scalar, x: pa.Scalar, scale: int) -> np.ndarray:
    """The whole components of a row of `quantised`."""
    if q.is_valid:
        return q.values.to_numpy()
    return np.array([math.floor(v * scale) if abs(v) < 2.0**900 else int(v) * scale for v in x.as_py()], object)


def _blocks(rows: list, scale: int) -> dict[int, SlicedBlock]:
    """A sliced block for each length of vector; null ids come last."""
    by_size = defaultdict(list)
    for vec_id, q, x in rows:
        values = _values(q, x, scale)
        by_size[len(values)].append((_LAST_ID if vec_id is None else vec_id, values))
    return {size: SlicedBlock(np.array([i for i, _ in own], np.int64), np.array([v for _, v in own], object if any(
        v.dtype == object for _, v in own) else np.int64).reshape(len(own), size)) for size, own in by_size.items()}


class SlicedBlock:
    """Bit slices of a block; rows in ascending order of id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[order], vectors[order]
        n, dims = vectors.shape
        self.lo = vectors.min(axis=0) if n else np.zeros(dims, vectors.dtype)
        lifted = vectors - self.lo
        self.bits = [int(lifted[:, d].max()).bit_length() for d in range(dims)]
        self.width = -(-n // 64)
        self.rows = self._pack(np.ones(n, bool))
        self.plus = [np.array([self._pack(((lifted[:, d] >> b) & 1).astype(np.uint8)) for b in range(self.bits[d])], np.uint64)
                     .reshape(self.bits[d], self.width) for d in range(dims)]
        self.minus = [x ^ self.rows for x in self.plus]  # (2^bits - 1) - x

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width * 8, np.uint8)
        packed = np.packbits(flags.astype(np.uint8), bitorder="little")
        out[:len(packed)] = packed
        return out.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of a non-negative total, and the constant that makes it the score."""
        base = int(sum(int(q) * int(lo) for q, lo in zip(query, self.lo, strict=True)))
        most = 0
        for q, bits in zip(query, self.bits, strict=True):
            most += abs(int(q)) * ((1 << bits) - 1)
            if q < 0:
                base += int(q) * ((1 << bits) - 1)
        high = max(1, most.bit_length())
        total, carry = np.zeros((high + 1, self.width), np.uint64), np.zeros((high + 2, self.width), np.uint64)
        for d, q in enumerate(map(int, query)):
            x = self.plus[d] if q > 0 else self.minus[d]
            q, bits = abs(q), self.bits[d]
            while q and bits:
                low = (q & -q).bit_length() - 1
                q &= q - 1
                s, c = total[low:], carry[low:-1]
                both = s & c
                half = s ^ c
                end = min(bits, len(half))
                both[:end] |= half[:end] & x[:end]
                half[:end] ^= x[:end]
                total[low:] = half
                carry[low + 1:] = both
                carry[low] = 0
        over = np.zeros(self.width, np.uint64)
        for i in range(high + 1):  # one ripple at the end
            half = total[i] ^ carry[i]
            total[i], over = half ^ over, (total[i] & carry[i]) | (half & over)
        return total, base

    def _rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, the query's own left out."""
        total, base = self.scores(query)
        own = self.ids == query_id
        live = self.rows & ~self._pack(own) if own.any() else self.rows
        sure = np.zeros_like(live)
        for piece in total[::-1]:
            both = live & piece
            n = int(np.bitwise_count(sure | both).sum())
            if n > k:
                live = both
            else:
                sure, live = sure | both, live & ~piece
                if n == k:
                    live = np.zeros_like(live)
                    break
        rows = self._rows_of(sure)
        rows = np.concatenate([rows, self._rows_of(live)[:k - len(rows)]])  # ties: smaller ids first
        flags = (total[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        if len(total) < 62 and abs(base) < 1 << 62:
            score = (flags.astype(np.int64) << np.arange(len(total))[:, None]).sum(axis=0) + base
        else:
            score = sum((f.astype(object) << i for i, f in enumerate(flags)), np.zeros(len(rows), object)) + base
        return self.ids[rows], score


def _encoded(score: int) -> tuple[int, int, str]:
    """A score as a long, clamped; on which side it lies beyond; and, beyond, a text that orders it."""
    if abs(score) <= _LAST_ID:
        return score, 0, ""
    digits = str(abs(score))
    if score > 0:
        return _LAST_ID, 1, f"{len(digits):06d}{digits}"
    return -_LAST_ID - 1, -1, f"{999_999 - len(digits):06d}{digits.translate(_COMPLEMENT)}"


def dealt(candidates: DataFrame, queries: DataFrame, n_blocks: int) -> DataFrame:
    """block, side (0: candidate, 1: query), vec_id, q, x: each candidate in one block, each query in
    every block, one partition a block, candidates first. The row number spreads repeated rows."""
    block = F.pmod(F.xxhash64("vec_id", "q", "x", "row"), F.lit(n_blocks)).cast("int")
    own = candidates.select(block.alias("block"), F.lit(0).alias("side"), "vec_id", "q", "x")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("side"), "vec_id", "q", "x")
    return own.unionByName(asked).repartitionById(n_blocks, F.col("block")).sortWithinPartitions("block", "side")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, *, block_rows: int = 16384, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates. Both inputs as `quantised`
    gives them. Candidates are dealt by hash into blocks of about `block_rows`. A task slices its
    block once and lets the queries stream past it, an Arrow batch at a time, so it holds one
    block and one batch; a vector is shuffled once, a query once a block."""
    table = written(candidates.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n_blocks = max(1, -(-table.count() // block_rows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, blocks = None, [], {}
        for batch in batches:
            found = []
            for i, (block, side, vec_id, q, x) in enumerate(zip(*(c.to_pylist() if j < 3 else c for j, c in enumerate(batch.columns)), strict=True)):
                if block != at:
                    at, waiting, blocks = block, [], {}
                if side == 0:
                    waiting.append((vec_id, q, x))
                    continue
                if waiting:  # the block is complete: its queries begin
                    blocks, waiting = _blocks(waiting, scale), []
                values = _values(q, x, scale)
                if len(values) in blocks:
                    got, score = blocks[len(values)].top(vec_id, values, k)
                    found += [(vec_id, int(v), *_encoded(int(s))) for v, s in zip(got, score, strict=True)]
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND.types, strict=True)], schema=_FOUND)

    best = (dealt(table.select("vec_id", "q", "x", "row"), queries.filter("vec_id IS NOT NULL").select("vec_id", "q", "x"), n_blocks)
            .mapInArrow(search, "query_id long, vec_id long, score long, beyond int, big string"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), F.desc("big"), "vec_id"))
    return (best.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != _LAST_ID, F.col("vec_id")).alias("vec_id"), "score"))
