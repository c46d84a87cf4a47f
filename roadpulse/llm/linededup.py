"""Removal of repeated line runs by a suffix array over line ids, in DataFrame functions alone.

Every document is the sequence of its lines; a blank line belongs to the line before it. Suffixes
are ranked by prefix doubling: a suffix's rank is the number of suffixes that sort before its
first k lines. A round takes k to 2k by counting (rank, rank k lines on) pairs and adding, within
each rank, the counts of the smaller pairs; those sums run over buckets of second ranks first, so
no task needs all pairs of a very common line. Suffixes with a rank of their own, and suffixes that
end, are settled and leave; rounds end when none is left. Suffixes that share a rank at depth k are
an interval of the suffix array whose longest common prefix is k lines or more. One that is
not the first of such an interval (k >= `min_lines`) begins a repeated run of k lines, which
goes; runs that touch join to the maximal repeated run. The first copy in order of doc_id and line
stays, also where copies lie in one document.

A null text is an empty one without lines. Null ids sort first. Rows equal in id and text are one
document and get the same cut. Very long texts are ordinary rows (narrow in every shuffle but the
last). An empty table gives an empty result. Further columns pass through, whatever their names.
Lines are told apart by 96 hash bits.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import apart, written

#: before a line with a word; what lies between two of these is a line with the blank ones after it
BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"
_KEY = ["__id", "__text"]
_LEAST = -(1 << 63)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (docs.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)))
            .withColumn("__text", F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __text, pos, left (lines from here to the end), a, b (96 hash bits of the line; null:
    no word in it)."""
    line = F.substring_index("line", "\n", 1)
    some = F.col("line").rlike(r"[^\x20\x09-\x0D]")
    return (_keyed(docs.select(id_col, text_col), id_col, text_col)
            .select(*_KEY, F.split(F.coalesce(F.col(text_col), F.lit("")), BREAK).alias("__lines"))
            .select(*_KEY, F.size("__lines").alias("n"), F.posexplode("__lines").alias("pos", "line"))
            .select(*_KEY, "pos", (F.col("n") - F.col("pos")).alias("left"), F.when(some, F.xxhash64(line)).alias("a"), F.when(some, F.crc32(line.cast("binary"))).alias("b"))
            .distinct())


def _starts(groups: DataFrame, of: list[str], bucket, order: list[str]) -> DataFrame:
    """`groups` with `before`: the sum of n over the groups with the same `of` that come earlier in
    `order`, by sums over buckets (which must ascend with `order`) and sums within each."""
    groups = groups.withColumn("bucket", bucket)
    sums = groups.groupBy(*of, "bucket").agg(F.sum("n").alias("m"))
    earlier = W.partitionBy(*of).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("m").over(earlier), F.lit(0))).drop("m")
    inside = W.partitionBy(*of, "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (groups.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(sums, [*of, "bucket"]).withColumn("before", F.col("base") + F.col("own")).drop("bucket", "base", "own"))


def repeated_runs(lines: DataFrame, min_lines: int = 2) -> DataFrame:
    """__id, __text, pos, depth: suffixes that repeat `depth` lines (a power of two or the rest of
    their document, at least `min_lines`) of an earlier suffix."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    first = F.min(F.struct("__id", "__text", "pos")).alias("first")
    symbols = lines.filter("a IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("n"), first)
    # 2^16 buckets by the leading hash bits: the sums over buckets have that many rows at most
    ranked = _starts(symbols.withColumn("all", F.lit(0)), ["all"], F.shiftright("a", 48).cast("int"), ["a", "b"])
    table = (lines.join(ranked.select("a", "b", "n", "first", F.col("before").alias("r")), ["a", "b"])
             .select(*_KEY, "pos", "left", "r", (F.col("n") > 1).alias("live"), (F.struct(*_KEY, "pos") > F.col("first")).alias("later")))
    table = written(table, "ranks")
    width = max(1024, math.isqrt(table.count()) * 4)
    found = [table.filter("later").select(*_KEY, "pos", F.lit(1).alias("depth"))] if min_lines == 1 else []
    k = 1
    while not table.filter("live").isEmpty():
        doc = W.partitionBy(*_KEY)
        moved = (table.withColumn("any", F.max("live").over(doc)).filter("any")  # documents all settled leave
                 .withColumn("r2", F.lead("r", k).over(doc.orderBy("pos"))).drop("any", "later"))
        moved = written(moved, "pairs")
        live = moved.filter("live AND r2 IS NOT NULL")
        pairs = live.groupBy("r", "r2").agg(F.count("*").alias("n"), first)
        # a suffix that ends after these k lines sorts before all that go on
        ended = moved.filter("live AND r2 IS NULL").groupBy("r").agg(F.count("*").alias("ended"))
        new = (_starts(pairs, ["r"], F.floor(F.col("r2") / width), ["r2"]).join(ended, "r", "left")
               .select("r", "r2", "n", "first", (F.col("r") + F.coalesce("ended", F.lit(0)) + F.col("before")).alias("rank")))
        rest = moved.filter("NOT (live AND r2 IS NOT NULL)").select(*_KEY, "pos", "left", "r", F.lit(False).alias("live"), F.lit(False).alias("later"))
        table = written(live.join(new, ["r", "r2"]).select(
            *_KEY, "pos", "left", F.col("rank").alias("r"), (F.col("n") > 1).alias("live"),
            (F.struct(*_KEY, "pos") > F.col("first")).alias("later")).unionByName(rest), "ranks")
        k *= 2
        if k >= min_lines:  # suffixes that end within these k lines share a rank if they are equal to their ends
            depth = F.least(F.lit(k), F.col("left"))
            found.append(table.filter(F.col("later") & (depth >= min_lines)).select(*_KEY, "pos", depth.alias("depth")))
    if not found:
        return lines.filter("false").select(*_KEY, "pos", F.lit(1).alias("depth"))
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    return runs.groupBy(*_KEY, "pos").agg(F.max("depth").alias("depth"))


def cut(docs: DataFrame, *, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`__row` (the row of `docs`), `__kept` (the text without later copies), `__n_lines`, `__n_removed`."""
    docs, id_col, text_col = apart(docs, doc_id=id_col, text=text_col), "doc_id", "text"
    lines = written(line_table(docs, id_col, text_col), "lines")
    runs = repeated_runs(lines, min_lines)
    # a line goes if a run that starts at or before it reaches it: the furthest end so far
    doc = W.partitionBy(*_KEY).orderBy("pos")
    masks = (lines.select(*_KEY, "pos").join(runs, [*_KEY, "pos"], "left")
             .withColumn("reach", F.max(F.col("pos") + F.col("depth")).over(doc))
             .select(*_KEY, F.struct("pos", F.coalesce(F.col("reach") > F.col("pos"), F.lit(False)).alias("gone")).alias("line"))
             .groupBy(*_KEY).agg(F.sort_array(F.collect_list("line")).alias("mask"), F.max(F.col("line")["gone"]).alias("any"))
             .filter("any").select(*_KEY, F.col("mask")["gone"].alias("__gone")))
    out = _keyed(docs, id_col, text_col).join(masks, _KEY, "left")
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), BREAK)
    kept = F.array_join(F.filter(split, lambda _, i: ~F.get("__gone", i)), "\n")
    words = F.filter(split, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (out.withColumn("__kept", F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept))
            .withColumn("__n_lines", F.size(words).cast("long"))
            .withColumn("__n_removed", F.coalesce(F.size(F.filter("__gone", lambda g: g)), F.lit(0)).cast("long"))
            .select("__row", "__kept", "__n_lines", "__n_removed"))


def table(docs: DataFrame, *, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (with a word), n_removed, kept_sha256 of every row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return cut(own, min_lines=min_lines).select(
        "__row.doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"))
