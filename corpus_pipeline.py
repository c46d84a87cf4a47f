"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, substring dedup, packing.

Each stage takes what its predecessor kept and returns the columns of `documents`, the last one the
packed pieces. A stage that changes a text also states its new length in n_chars, where that column
is there. Rows without a doc_id are judged and cut like others and are never taken for a copy; rows
that repeat a doc_id with texts that are no near copies all stay. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import linededup, packing, quality, simhash, substring
from roadpulse.llm.common import apart, read, written

SEQUENCE_TOKENS = 4096
END_ID = 2


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of `docs` (`__row` of `changed`) with the text that was kept (`__kept`)."""
    new = {"text": F.col("__kept"), "n_chars": F.length("__kept")}
    return changed.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col("__row").getField(f.name)).alias(f.name)
                            for f in docs.schema])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the base limits or the posterior reject go."""
    return quality.kept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: later copies of repeated lines and line runs go; every document stays."""
    return _with_text(docs, linededup.cut(docs, min_lines=1))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group the document with the smallest doc_id stays, of several texts under
    that id the one with the smallest hash."""
    groups = simhash.near_duplicates(docs, shingle=3, radius=2)
    # a component's smallest doc_id is its name; two components share it if an id repeats
    first = (groups.filter("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("first"))
             .select(F.col("first.doc_id").alias("__id"), F.col("first.h").alias("__h")))
    rows = apart(docs, doc_id="doc_id", text="text")
    keyed = rows.select("__row", F.col("doc_id").cast("long").alias("__id"), simhash.text_hash(F.col("text")).alias("__h"))
    kept = keyed.join(first, ["__id", "__h"], "left_semi").dropDuplicates(["__id", "__h"])
    return kept.select("__row.*").unionAll(rows.filter("doc_id IS NULL").select("__row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: passages of 50 words that a document with a smaller id holds go."""
    return _with_text(docs, substring.cut(docs, 50))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of packed sequences."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, lambda: packing.word_tokens(path), end_id=END_ID, seq_len=SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", sequence_packing),
]

#: expectation-maximisation, fingerprints and tokenizers are beyond SQL; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
