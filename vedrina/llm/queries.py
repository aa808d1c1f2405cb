"""The check queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.llm import conversations, exact_dedup, html_text, language_model, lexical, licenses, line_runs, mixing, quality, simhash, toxicity
from vedrina.llm import sentencepiece as pieces_codec
from vedrina.llm import token_counts as counts
from vedrina.llm.sql import DEDUP_SQL, LICENSE_SQL, LINES_SQL, MIXING_SQL, QUALITY_SQL, SEARCH_SQL
from vedrina.llm.text import filled


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_documents(spark, sf_dir))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    return language_model.lm_scores(_documents(spark, sf_dir), held_out)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(filled("text"), 256)}
    return exact_dedup.exact_copies(_documents(spark, sf_dir), carry=digest)


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_codec.encoded_and_checked(_documents(spark, sf_dir))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    judged = quality.quality_cascade(docs)
    measured = quality.with_measures(judged)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"),
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1
    lexicon = toxicity.learn(docs, labels.select("doc_id", "toxic"), ~held_out)
    scores = toxicity.scored(docs.select("doc_id", "text"), lexicon)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_text.extracted(pages, html_text.learn(pages))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    known = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    damage = F.pmod(F.crc32(F.concat_ws(":", *known)), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    damaged = rows.withColumn("damage", damage).filter("damage <> 0").select(
        "conv_id", "turn",
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, 2).otherwise(1))).alias("copy"),
    )
    repair = conversations.repair(damaged)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = rows.select("conv_id").distinct()
    for side in (repair.conversations, conversations.digests(repair)):
        side = side.withColumnRenamed("conv_id", "own_id")
        found = found.join(side, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").drop("own_id")
    return found.select(
        "conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(_documents(spark, sf_dir))
    return lexical.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.deduplicated(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts,
    "op2_lm_scores": lm_scores,
    "op3_license_scan": license_scan,
    "op4_exact_dedup": exact_copies,
    "op5_sentencepiece": encoded,
    "op6_quality_rules": quality_rules,
    "op7_mixing": mixed,
    "op8_toxicity": toxic,
    "op9_html_text": main_texts,
    "op10_simhash": near_duplicates,
    "op11_conversations": repaired_conversations,
    "op12_lexical_search": ranked_search,
    "op13_line_dedup": line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": LICENSE_SQL,
    "op4_exact_dedup": DEDUP_SQL,
    "op6_quality_rules": QUALITY_SQL,
    "op7_mixing": MIXING_SQL,
    "op12_lexical_search": SEARCH_SQL,
    "op13_line_dedup": LINES_SQL,
}
