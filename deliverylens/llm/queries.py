"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import burst_trie, byte_bpe, lm_contrast, merkle, near_dedup, pfair_mix, quality_fm, quality_rules, quartile_digest, suffix_dedup, toxicity, trie_bpe, url_filter

QUALITY_CUT = 0.7
TARGET_SOURCES = ("src1", "src2")
TOXIC_CUT = 0.5
#: Labels of hosts whose pages make the list of operator 8.
LISTED_LABELS = ("adult-x", "casino-win", "free-bets", "spam-farm")
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"


def checksum(parts: int) -> Column:
    """The remainder by which labelled rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left in every document once 50-byte strings of smaller ids are gone."""
    found = suffix_dedup.find_repeats(documents(spark, sf_dir))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select(F.col("rest.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", digest)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and near-duplicate group of every document."""
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def learned_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_fm.Machine:
    """The classifier, from labelled rows outside the held-out part."""
    return quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", learn=checksum(4) != 2)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, sf_dir)
    scored = quality_fm.score(docs, learned_quality(spark, docs, sf_dir)).select("rest.doc_id", "score")
    held_out = F.coalesce(checksum(4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the bytes they decode to."""
    out = byte_bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return out.select(
        "rest.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_lm_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between the trusted sources and all others."""
    docs = documents(spark, sf_dir)
    return lm_contrast.score(docs, F.col("source").isin(*TARGET_SOURCES))


def op6_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    made = quartile_digest.edit_chain(documents(spark, sf_dir))
    return made.select("rest.doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and the verdict of the base and of the chosen cutoffs."""
    judged = quality_rules.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("rest.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def listed_urls(pages: DataFrame) -> DataFrame:
    """The URLs of the list: those of pages on hosts whose name has a listed label."""
    host = F.split(url_filter.host_of(F.col("url")), r"\.")
    return pages.where(F.arrays_overlap(host, F.array(*map(F.lit, LISTED_LABELS)))).select("url").distinct()


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge(pages, listed_urls(pages)).select("page.page_id", "host", "path", "rule", "verdict")


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mixture that weighs sources by the square root of their size."""
    return pfair_mix.mix(documents(spark, sf_dir).select("doc_id", "source"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", learn=checksum(5) != 0)
    scored = toxicity.score(docs, model).select("rest.doc_id", "score")
    held_out = F.coalesce(checksum(5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return burst_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its row still folds to the root after a third of the texts is lower-cased."""
    changed = (checksum(3) == 0) & F.col("text").isNotNull()
    made = merkle.manifest(documents(spark, sf_dir), url_filter.lower_ascii(F.col("text")), changed)
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the text they decode to."""
    out = trie_bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path(WORD_FILE))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("rest.doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_lm_contrast": op5_lm_contrast,
    "op6_quartile_digest": op6_quartile_digest,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_pfair_mix": op9_pfair_mix,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_word_bpe": op13_word_bpe,
}

_URL_PARTS = """
    SELECT page_id, url, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages)
"""

ORACLES: dict[str, str] = {
    "op8_url_filter": f"""
        WITH parts AS ({_URL_PARTS}),
        keyed AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '') END AS key FROM parts),
        listed AS (SELECT DISTINCT key FROM keyed
                   WHERE list_has_any(string_split(host, '.'), ['adult-x', 'casino-win', 'free-bets', 'spam-farm'])),
        ruled AS (SELECT *, CASE
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM keyed)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
}
