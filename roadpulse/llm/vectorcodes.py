"""Product codes of vectors by Lloyd's rounds that look only at entries which moved.

Every component x becomes the integer floor(scale * x) and a vector is cut into `parts` equal
pieces; each piece position has a codebook, which starts as that piece of the vectors with the
smallest ids. A round assigns every piece to its codebook's nearest entry (squared distance, ties to
the lower index) and replaces each entry by the floored mean of its pieces; an entry without
pieces stays. A last assignment follows the rounds.

A piece whose entry did not move in the last update keeps its exact distance and is compared with
the moved entries alone: the entries that stayed were no better before and are none now. A piece
whose entry moved is compared with all entries. Pieces, codes and distances are one table per
round, written to the shared folder beside the round's sums, so a lost executor costs a re-read; the
driver holds the codebooks and adds up one row per part, entry and limb.

Distances are exact: products of small components are whole numbers in float64 matrix products,
larger ones (any finite number) are Python integers, whose sums travel in limbs of 20 bits. An
error or a sum of errors beyond a long is given as the largest long.

Vectors that are null or hold null or non-finite components take no part, nor do vectors of another
length than the one with the smallest id (of several under that id, the smallest vector); a length that
is no multiple of `parts` is filled up with zeros. A null id comes after all others, repeated rows
count as often as they occur, fewer vectors than entries give a shorter codebook, an empty table
gives an empty result; null labels form one label, and further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import written

_LONG = np.iinfo(np.int64).max
_LIMB = 20


def whole(x: float, scale: int) -> int:
    """floor(scale * x) of any finite x."""
    return math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale


def _bits(width: int) -> int:
    """Components below 2^bits keep each term of a squared distance exact in float64."""
    return (50 - max(1, width).bit_length()) // 2


def prepared(table: DataFrame, parts: int, entries: int, scale: int, id_col: str, vector_col: str,
             label_col: str) -> tuple[DataFrame, list[list[list[int]]]]:
    """vec_id, label, q (small components, else null), x (components as they are where q is null),
    and the first codebooks."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = table.filter(F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), x.alias("x"))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    if not first:
        return rows.filter("false").select("vec_id", "label", F.lit(None).cast("array<long>").alias("q"), "x"), [[] for _ in range(parts)]
    size = len(first[0].x)
    width = -(-size // parts)
    small = F.forall("x", lambda v: F.abs(v) < 2.0 ** _bits(width) / scale - 1)
    filled = F.concat(F.col("x"), F.array_repeat(F.lit(0.0), width * parts - size))
    rows = rows.filter(F.size("x") == size).select(
        "vec_id", "label", F.when(small, F.transform(filled, lambda v: F.floor(v * scale))).alias("q"),
        F.when(~small, filled).alias("x"))
    own = [[whole(v, scale) for v in r.x] + [0] * (width * parts - size) for r in first if len(r.x) == size]
    return rows, [[v[p * width:(p + 1) * width] for v in own] for p in range(parts)]


class Book:
    """One codebook in a task: its small entries for exact matrix products, the others as integers."""

    def __init__(self, entries: list[list[int]], width: int):
        bound = 1 << _bits(width)
        own = np.array(entries, object).reshape(len(entries), width)
        low = np.array([all(abs(v) < bound for v in e) for e in entries], bool)
        self.small, self.wide = np.flatnonzero(low), np.flatnonzero(~low)
        self.at = own[self.small].astype(np.float64)
        self.norm = (self.at * self.at).sum(axis=1)
        self.far = own[self.wide]

    def nearest(self, pieces: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest of the entries flagged in `among`; -1 if none."""
        code, best = np.full(len(pieces), -1), np.full(len(pieces), None, object)
        if pieces.dtype != object:
            best = np.full(len(pieces), _LONG)
        near = among[self.small]
        if near.any() and pieces.dtype != object:
            d = (pieces * pieces).sum(axis=1)[:, None] - 2 * (pieces @ self.at[near].T) + self.norm[near]
            at = d.argmin(axis=1)  # the first of equal ones
            code, best = self.small[near][at], d[np.arange(len(d)), at].astype(np.int64)
            rest, numbers = self.far[among[self.wide]], self.wide[among[self.wide]]
        else:
            flagged = among[self.small], among[self.wide]
            rest = np.concatenate([self.at[flagged[0]].astype(np.int64).astype(object), self.far[flagged[1]]])
            numbers = np.concatenate([self.small[flagged[0]], self.wide[flagged[1]]])
        if len(rest):
            exact = pieces if pieces.dtype == object else pieces.astype(np.int64).astype(object)
            code, best = code.copy(), best.astype(object)
            for entry, i in zip(rest, numbers, strict=True):
                d = ((exact - entry) ** 2).sum(axis=1) if exact.shape[1] else np.zeros(len(exact), object)
                for r in range(len(exact)):
                    if code[r] < 0 or (d[r], i) < (best[r], code[r]):
                        code[r], best[r] = i, d[r]
        return code, best


def assigned(rows: DataFrame, books: list[list[list[int]]], moved: list[set[int]] | None, scale: int) -> DataFrame:
    """`rows` with code, dist (per part; -1 if it does not fit) and error; and, as rows with a `part`, the
    sums of the pieces of each entry. Without `moved` every piece is compared with all entries."""
    parts, n_entries, width = len(books), len(books[0]), len(books[0][0])
    label_type = rows.schema["label"].dataType.simpleString()
    known = moved is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b, width) for b in books]
        everything = np.ones(n_entries, bool)
        changed = [np.array([e in moved[p] for e in range(n_entries)]) for p in range(parts)] if known else None
        total = np.zeros((parts, n_entries, width), np.int64)
        number = np.zeros((parts, n_entries), np.int64)
        limbs: dict[tuple[int, int, int], list[int]] = defaultdict(lambda: [0] * width)

        def settle(vectors: np.ndarray, code: np.ndarray, dist: np.ndarray) -> None:
            """Fill in `code` and `dist` (objects), read as the last round's where `known`."""
            for p in range(parts):
                pieces = vectors[:, p * width:(p + 1) * width]
                fixed = (dist[:, p] >= 0).astype(bool) & ~changed[p][code[:, p]] if known else np.zeros(len(pieces), bool)
                if not fixed.all():
                    code[~fixed, p], dist[~fixed, p] = own[p].nearest(pieces[~fixed], everything)
                if fixed.any() and changed[p].any():
                    at, d = own[p].nearest(pieces[fixed], changed[p])
                    old, now = dist[fixed, p], code[fixed, p]
                    better = (d < old) | ((d == old) & (at < now))
                    code[fixed, p], dist[fixed, p] = np.where(better, at, now), np.where(better, d, old)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q, x = batch.column(2), batch.column(3)
            if known:
                code = batch.column(4).flatten().to_numpy().reshape(n, parts).astype(np.int64)
                dist = batch.column(5).flatten().to_numpy().reshape(n, parts).astype(object)
            else:
                code, dist = np.zeros((n, parts), np.int64), np.full((n, parts), -1, object)
            wide = np.flatnonzero(q.is_null().to_numpy(zero_copy_only=False))
            near = np.flatnonzero(q.is_valid().to_numpy(zero_copy_only=False))
            if len(near):
                vectors = q.flatten().to_numpy().reshape(len(near), parts * width).astype(np.float64)
                c, d = code[near], dist[near]
                if all(not len(b.wide) for b in own):
                    d = d.astype(np.int64)
                settle(vectors, c, d)
                code[near], dist[near] = c, d
                flat = vectors.astype(np.int64).reshape(len(near), parts, width)
                for p in range(parts):
                    np.add.at(total[p], c[:, p], flat[:, p])
                    number[p] += np.bincount(c[:, p], minlength=n_entries)
            if len(wide):
                vectors = np.array([[whole(v, scale) for v in x[int(i)].as_py()] for i in wide], object).reshape(len(wide), parts * width)
                c, d = code[wide], dist[wide]
                settle(vectors, c, d)
                code[wide], dist[wide] = c, d
                for v, e in zip(vectors, c, strict=True):
                    for p in range(parts):
                        number[p, e[p]] += 1
                        for j, value in enumerate(v[p * width:(p + 1) * width]):
                            limb, rest, sign = 0, abs(value), 1 if value >= 0 else -1
                            while rest:
                                limbs[p, int(e[p]), limb][j] += sign * (rest & ((1 << _LIMB) - 1))
                                limb, rest = limb + 1, rest >> _LIMB
            error = [min(_LONG, int(sum(r))) for r in dist.tolist()]
            kept = np.array([[v if v <= _LONG else -1 for v in r] for r in dist.tolist()], np.int64).reshape(n, parts)
            offsets = pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32))
            none = lambda kind: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:4], pa.ListArray.from_arrays(offsets, pa.array(code.ravel(), pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(kept.ravel())), pa.array(error, pa.int64()),
                none(pa.int32()), none(pa.int32()), none(pa.int32()), none(pa.int64()), none(pa.list_(pa.int64()))], names=names)
        sums = [(p, e, 0, int(number[p, e]), total[p, e].tolist()) for p, e in zip(*np.nonzero(number), strict=True)]
        sums += [(p, e, limb, 0, values) for (p, e, limb), values in limbs.items()]
        if sums:
            part, entry, limb, n, values = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(len(sums), f.type) for f in arrow), pa.array(map(int, part), pa.int32()), pa.array(map(int, entry), pa.int32()),
                pa.array(limb, pa.int32()), pa.array(n, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=names)

    schema = f"vec_id long, label {label_type}, q array<long>, x array<double>, code array<int>, dist array<long>, error long, " \
             "part int, entry int, limb int, n long, sums array<long>"
    from pyspark.sql.pandas.types import to_arrow_schema

    out = rows.sparkSession.createDataFrame([], schema).schema
    names, arrow = out.names, list(to_arrow_schema(out))[:7]
    own = ["vec_id", "label", "q", "x"] + (["code", "dist"] if known else [])
    return rows.select(*own).mapInArrow(run, out)


def _updated(state: DataFrame, books: list[list[list[int]]]) -> tuple[list[list[list[int]]], list[set[int]]]:
    """The codebooks after an assignment, and what moved. At most parts * entries * limbs rows come."""
    width = len(books[0][0])
    component = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    got = state.filter("part IS NOT NULL").groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), *component).collect()
    sums: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0] * width)
    number: dict[tuple[int, int], int] = defaultdict(int)
    for r in got:
        key = (r.part, r.entry)
        number[key] += r.n
        sums[key] = [s + (r[f"s{i}"] << (_LIMB * r.limb)) for i, s in enumerate(sums[key])]
    after = [[[s // number[p, e] for s in sums[p, e]] if number.get((p, e)) else old for e, old in enumerate(book)] for p, book in enumerate(books)]
    return after, [{e for e, old in enumerate(book) if after[p][e] != old} for p, book in enumerate(books)]


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def compress(table: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """(vec_id, label, codes (array of int), error) of every vector that takes part, and the codebooks
    by part, entry and component."""
    rows, books = prepared(table, parts, entries, scale, id_col, vector_col, label_col)
    if not books[0]:
        return rows.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")), books
    moved = None
    for i in range(rounds + 1):
        state = written(assigned(rows, books, moved, scale), f"vector-codes-{i}")
        rows = state.filter("part IS NULL")
        if i < rounds:
            books, moved = _updated(state, books)
    return rows.select("vec_id", "label", F.col("code").alias("codes"), "error"), books


def table(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part, more where there are more than 256 entries), error,
    label_error, codebooks_sha256."""
    found, books = compress(vectors, **options)
    digits = max(2, len(f"{max(0, len(books[0]) - 1):x}"))
    of_label = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = found.groupBy("label").agg(F.least(of_label, F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), digits, "0"))))
    return (found.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", code.alias("code"), "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))
