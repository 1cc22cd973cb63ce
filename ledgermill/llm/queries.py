"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.chosen_path import near_duplicate_groups
from ledgermill.llm.filter_audit import audit_filters
from ledgermill.llm.language import held_out, label_languages, train_language_model
from ledgermill.llm.latent import contaminated
from ledgermill.llm.licenses import license_matches, license_summary
from ledgermill.llm.markov import score_texts
from ledgermill.llm.mixing import mix_documents
from ledgermill.llm.periodic import periodic_runs
from ledgermill.llm.simhash import edit_fingerprints, radius_for, with_near
from ledgermill.llm.token_counts import count_tokens
from ledgermill.llm.token_files import read_token_files, write_token_files
from ledgermill.llm.url_rules import Rule, judge_pages
from ledgermill.llm.weak_labels import score_quality
from ledgermill.sources.paths import fresh_folder, stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the 50k byte-level vocabulary."""
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited form.

    For ids divisible by 50, ``near_count`` and ``near_ids`` give the other
    fingerprints of all documents within the radius that holds 99 % of the pairs of
    similarity 0.8. Documents of equal fingerprints share a ``class_id``, and
    ``near_ids`` holds class ids.
    """
    prints = stored(edit_fingerprints(table(spark, folder, "documents")), "fingerprints")
    return with_near(prints, F.col("doc_id") % 50 == 0, radius_for(0.8, 0.99))


def op3_latent_retrieval(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, whole or in other words: one row for each document and item."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three of four of them."""
    docs = table(spark, folder, "documents")
    model = train_language_model(docs.where(~held_out("doc_id", 4, 2)))
    return label_languages(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "unknown")


#: The rules of the query.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page url."""
    return judge_pages(table(spark, folder, "pages"), URL_RULES)


def op6_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document from labellers that disagree."""
    return score_quality(table(spark, folder, "documents"))


def op7_markov_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every document by a model learned from four of five of them."""
    scored = score_texts(table(spark, folder, "documents"), ~held_out("doc_id", 5, 1))
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


#: Shares of tokens that the domains of the labelled table shall have.
TARGET_WEIGHTS = {"clean": 0.93, "poor": 0.07, "toxic": 0.0}


def op8_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of every document that brings its domains to the target weights."""
    mixed, _ = mix_documents(table(spark, folder, "documents"), table(spark, folder, "labels"), TARGET_WEIGHTS)
    return mixed


def op9_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of three-word runs are similar by 0.85 or more."""
    return near_duplicate_groups(table(spark, folder, "documents"), words_per_shingle=3, threshold=0.85)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, written to files and read back from them."""
    out = fresh_folder(spark, "tokens")
    write_token_files(table(spark, folder, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, out)


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove, keep and repeat in every order, by source."""
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def with_repeated_end(docs: DataFrame) -> DataFrame:
    """Texts of which about a tenth (by the id) end in words that repeat with one period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    numbers = chosen.select("*", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a")).select(
        "*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p")
    )
    edited = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))),
    )
    return numbers.select("doc_id", F.when(F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a repeated end."""
    found = periodic_runs(with_repeated_end(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op13_license_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and signatures of every document."""
    return license_summary(license_matches(table(spark, folder, "documents")))


REGISTRY: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_simhash": op2_simhash,
    "op3_latent_retrieval": op3_latent_retrieval,
    "op4_language": op4_language,
    "op5_url_rules": op5_url_rules,
    "op6_weak_labels": op6_weak_labels,
    "op7_markov_model": op7_markov_model,
    "op8_soft_mixing": op8_soft_mixing,
    "op9_chosen_path": op9_chosen_path,
    "op10_token_files": op10_token_files,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_license_signatures": op13_license_signatures,
}
