"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import read


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.packing import pack, word_tokens

    path = _vocabulary("word_bpe_49k.json")
    return pack(read(spark, sf_dir, "documents"), lambda: word_tokens(path), end_id=2)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.piece_bpe import code

    return code(read(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.linededup import table

    return table(read(spark, sf_dir, "documents"), min_lines=1)  # a line that repeats alone is a run, too


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.quality import table

    return table(read(spark, sf_dir, "documents")).drop("good")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.toxicity import score

    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.licenses import scan

    return scan(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.simhash import near_duplicates

    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.substring import table

    return table(read(spark, sf_dir, "documents"), 50)


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.topk import quantised, top_k

    vectors = quantised(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.sharding import shard_rows

    return shard_rows(read(spark, sf_dir, "documents"), 24)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.vectorcodes import table

    return table(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.personal import scan

    return scan(read(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadpulse.llm.resample import resample

    found = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_packing, op2_line_dedup, op3_sentencepiece, op4_quality, op5_toxicity, op6_license_scan, op7_simhash,
        op8_substring, op9_topk_search, op10_sharding, op11_vector_codes, op12_personal_data,
        op13_resample)}
