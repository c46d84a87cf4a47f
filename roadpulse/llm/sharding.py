"""Vector bin packing of rows into shards, bytes, tokens and rows balanced jointly.

Rows of equal text form a group and a group goes to one shard, unless it alone holds more than
`split_above` of a shard's share of rows or bytes; such a group is spread row by row, or no
balance would be possible. Groups are bundled by hash into at most `n_shards *
bundles_per_shard` bundles, so what the driver places has a fixed bound whatever the table's
size. Each bundle, largest first, goes to the shard where the dot product of its (bytes,
tokens, rows) vector with the shard's residual capacity is highest.

Null texts count as empty, null ids are ordinary rows, repeated rows each get a slot of their
own, an empty table gives an empty result, and further columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import words, written

#: bytes first: the law; tokens and rows break what bytes leave open
WEIGHTS = (1.0, 0.1, 0.05)


def place(loads: np.ndarray, n_shards: int, weights=WEIGHTS) -> np.ndarray:
    """Shard of every bundle. `loads`: one row (bytes, tokens, rows) per bundle."""
    total = loads.sum(axis=0)
    unit = loads / np.where(total > 0, total, 1) * n_shards * np.asarray(weights)
    residual = np.tile(np.asarray(weights, float), (n_shards, 1))
    shard = np.empty(len(loads), int)
    for i in np.lexsort((np.arange(len(loads)), -loads[:, 0])):
        shard[i] = np.argmax(residual @ unit[i])
        residual[shard[i]] -= unit[i]
    return shard


def shard_rows(docs: DataFrame, n_shards: int = 24, *, bundles_per_shard: int = 512, split_above: float = 0.5,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.size(words(text)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g"),
        F.monotonically_increasing_id().alias("row")), "shard-base")
    bundles = n_shards * bundles_per_shard
    rows, size = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    # at most 2 * n_shards / split_above groups can pass either bound (96 here)
    hot = (base.groupBy("g").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
           .filter((F.col("b") > size * split_above / n_shards) | (F.col("n") > max(1, rows * split_above / n_shards)))
           .select("g", F.lit(True).alias("hot")))
    spread = F.when(F.col("hot"), F.xxhash64("g", "doc_id", "row")).otherwise(F.col("g"))
    # the hashes themselves order the groups, so bundles are drawn from a second, unrelated hash
    dealt = base.join(F.broadcast(hot), "g", "left").withColumn("bundle", F.pmod(F.xxhash64(spread), F.lit(bundles)).cast("int"))
    loads = dealt.groupBy("bundle").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"),
                                        F.count("*").alias("n")).orderBy("bundle").collect()
    schema = "bundle int, shard int, first long"
    if not loads:
        at = spark.createDataFrame([], schema)
    else:
        shard = place(np.array([[r.b, r.t, r.n] for r in loads], float), n_shards)
        first, filled = [], [0] * n_shards
        for r, s in zip(loads, shard, strict=True):
            first.append((r.bundle, int(s), filled[s]))
            filled[s] += r.n
        at = spark.createDataFrame(first, schema)
    within = F.row_number().over(W.partitionBy("bundle").orderBy("doc_id", "text_crc32", "size"))
    return (dealt.join(F.broadcast(at), "bundle")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + within - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
