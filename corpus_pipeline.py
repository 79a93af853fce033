"""A corpus pipeline of five operators, each stage written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import byte_bpe, near_dedup, pfair_mix, quality_fm, suffix_dedup
from deliverylens.llm.queries import QUALITY_CUT, RANK_FILE, learned_quality
from deliverylens.session import run_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the classifier rejects go. A null text is an empty one from here on."""
    scored = quality_fm.score(docs, learned_quality(spark, docs, sf_dir)).where(F.col("score") >= QUALITY_CUT)
    return scored.select(*(F.col("bytes").cast("string").alias(c) if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group of near duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: byte strings that an earlier document holds are cut out."""
    cut = suffix_dedup.strip_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the rows get their place in the mixture, which readers of several files would lose."""
    return pfair_mix.mix(docs).drop(*pfair_mix.own_names(docs.columns)[:2])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids, whether they decode to the text, and the place in the mixture."""
    out = byte_bpe.encode_decode(docs.withColumn("original", F.coalesce(F.col("text"), F.lit("")).cast("binary")), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    place = max((c for c in docs.columns if c.rstrip("_") == "place"), key=len)  # the operator's, beside a column of that name
    return out.select("rest.doc_id", "rest.lang", "rest.source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("rest.original")).alias("round_trip"), F.col(f"rest.`{place}`").alias("place"))


STAGES = [
    ("quality_classifier", keep_good),
    ("near_dedup", keep_first),
    ("suffix_dedup", cut_repeats),
    ("pfair_mix", mix_sources),
    ("byte_bpe", encode),
]

#: No SQL: the classifier is trained.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
