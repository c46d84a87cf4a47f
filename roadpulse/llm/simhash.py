"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Equal fingerprints are merged first. The others are laid out in cells by the population counts of
`blocks` equal parts of the 64 bits. Fingerprints at most `radius` bits apart lie in cells whose
counts differ by at most `radius` in sum, so all other pairs of cells are skipped unread. Within
the pairs that remain, tiles of at most `tile_rows` fingerprints are compared completely by
numpy exclusive-or and bit counts. A cell with more rows is split into tiles, so no task holds
more than a tile and a strip of visitors. Each comparison hands on a spanning star of the linked
fingerprints, never all their pairs; components come from those stars.

A null or wordless text has fingerprint zero and is linked like any other. Null doc_ids take
part; a component without any doc_id has a null component_id. Repeated rows, very long texts and
empty tables are ordinary; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import written
from roadpulse.llm.components import components

SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles (A-Z in lower case, ASCII white space between words)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashed = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", n)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        part = hashed[low:low + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, f (the fingerprint as a signed long), h (a hash of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or "", shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], names=["doc_id", "f", "h"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("h")).mapInArrow(run, "doc_id long, f long, h long")


def star(rows: np.ndarray, others: np.ndarray, radius: int, strip: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what lies within `radius`, `rows` against `others` (or
    against themselves, if these are the same array)."""
    if int(np.bitwise_count(rows).max()) + radius < int(np.bitwise_count(others).min()) \
            or int(np.bitwise_count(others).max()) + radius < int(np.bitwise_count(rows).min()):
        return rows[:0], rows[:0]
    same = rows is others
    every = rows if same else np.concatenate([rows, others])
    label, shift = np.arange(len(every)), 0 if same else len(rows)
    step = max(1, strip // max(1, len(others)))
    linked = False
    for low in range(0, len(rows), step):
        near = np.bitwise_count(rows[low:low + step, None] ^ others[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + low, j + shift
        if same:
            i, j = i[i < j], j[i < j]
        while len(i):  # labels sink to the smallest of each component seen so far
            linked = True
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
    if not linked:
        return rows[:0], rows[:0]
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[moved], every[label[moved]]


def links(nodes: DataFrame, radius: int = 2, *, blocks: int = 4, tile_rows: int = 8192) -> DataFrame:
    """a, b: links that connect all fingerprints f of `nodes` (distinct) within `radius` bits."""
    width = 64 // blocks
    base = width + 1
    mask = (1 << width) - 1 if width < 64 else -1
    if base**blocks > 1 << 30:
        raise ValueError("more cells than 2^30: take fewer blocks")
    # as many cells as fit into a small table go to every executor; more are joined as the engine sees fit
    sent = F.broadcast if base**blocks <= 1 << 17 else lambda cells: cells
    counts = [F.bit_count(F.shiftrightunsigned("f", i * width).bitwiseAND(F.lit(mask))) for i in range(blocks)]
    place = sum((c * base**i for i, c in enumerate(counts)), F.lit(0)).cast("int")
    laid = written(nodes.select("f", place.alias("cell")), "fingerprints")
    # at most (width + 1)^blocks cells, whatever the table's size
    cells = laid.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    # half of the neighbouring cells: each pair of cells meets once, in the later one
    steps = [s for s in product(range(-radius, radius + 1), repeat=blocks) if sum(map(abs, s)) <= radius and s[::-1] > (0,) * blocks]
    old = lambda i: F.pmod(F.floor(F.col("cell") / base**i), F.lit(base))
    inside = [(sum(x * base**i for i, x in enumerate(s)), [(old(i) + x).between(0, width) for i, x in enumerate(s) if x]) for s in steps]
    visits = F.filter(F.array(*[_all(ok, F.col("cell") + F.lit(d)) for d, ok in inside]), lambda c: c.isNotNull())
    own = (laid.join(sent(cells), "cell")
           .withColumn("tile", F.pmod(F.xxhash64("f"), F.col("tiles")).cast("int")))
    home = own.select("f", "cell", "tile", F.lit(0).alias("guest"))
    beside = (own.filter("tile + 1 < tiles")  # rows of a split cell visit its later tiles
              .select("f", "cell", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)).alias("tile"), F.lit(1).alias("guest")))
    abroad = (laid.select("f", F.explode(visits).alias("cell")).join(sent(cells), "cell")
              .select("f", "cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(1).alias("guest")))
    dealt = (home.unionByName(beside).unionByName(abroad)
             .repartition("cell", "tile").sortWithinPartitions("cell", "tile", "guest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, None  # the tile at hand and its own fingerprints
        for batch in batches:
            f, cell, tile, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            key = (cell.astype(np.int64) << 33) | (tile.astype(np.int64) << 1) | guest
            edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            found = []
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if low == high:
                    continue
                part = f[low:high].view(np.uint64)
                here = int(key[low])
                if here & 1:
                    if at == here >> 1:
                        found.append(star(rows, part, radius))
                else:
                    if at == here >> 1:  # the tile goes on in a new batch
                        found += [star(rows, part, radius), star(part, part, radius)]
                        rows = np.concatenate([rows, part])
                    else:
                        at, rows = here >> 1, part.copy()
                        found.append(star(rows, rows, radius))
            if found:
                a, b = (np.concatenate([x[k] for x in found]).view(np.int64) for k in (0, 1))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _all(conditions: list, value):
    ok = conditions[0]
    for c in conditions[1:]:
        ok = ok & c
    return F.when(ok, value.cast("int"))


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    blocks: int = 4, tile_rows: int = 8192) -> DataFrame:
    """doc_id, f, h (a hash of the text), root (the component's key), component_id (the smallest doc_id that links reach) of
    every row."""
    marked = written(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "simhash")
    nodes = written(marked.groupBy("f").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    grouped = components(links(nodes.select("f"), radius, blocks=blocks, tile_rows=tile_rows))
    joined = nodes.join(grouped.withColumnRenamed("node", "f"), "f", "left").withColumn("root", F.coalesce("root", "f"))
    roots = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(roots, "root").select("f", "root", "component_id")
    return marked.join(named, "f").select("doc_id", "f", "h", "root", "component_id")
