"""The corpus pipeline: language, near copies, repeated strings, benchmark passages, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import decontaminate, langid, minhash, mixing, substrings
from quillon.llm.common import Scratch

#: Bytes of a repeated string: less than 50 words take, 242 at least in 20 000 documents of prose.
REPEAT = 220


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known: texts null, empty or without letters go, and those of no given language whose prediction is ambiguous. A null lang becomes the prediction."""
    return langid.keep_known(docs, langid.learn(docs, langid.third() != 1))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies."""
    return minhash.keep_one(docs, Scratch(spark))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of ``REPEAT`` bytes stay in the first document that holds them and are cut out of later ones; n_chars is counted anew. Texts cut to nothing go."""
    return substrings.cut_repeats(docs, Scratch(spark), REPEAT, True).withColumn("n_chars", _length(docs))


def _length(docs: DataFrame):
    from pyspark.sql import functions as F

    return F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chooses documents by the target weights; further columns (mix_path, mix_tokens, mix_copies) tell each one's leaf, tokens and copies."""
    return mixing.mix_sources(docs, mixing.levels(), mixing.WEIGHTS, Scratch(spark))


STAGES = [
    ("language id", known_language),
    ("minhash near-dedup", near_copies),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_passages),
    ("source mixing", mixture),
]

#: SQL has no trained classifier, banded alignment or 400-byte windows at this size: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written as Parquet to the shared folder and read again."""
    scratch, docs = Scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = scratch.save(out) if i + 1 < len(STAGES) else out
    return docs
