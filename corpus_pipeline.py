"""Documents to token files in five stages, each on what the one before kept.

Language ID drops texts without a language that can be told; near-dedup leaves one
document of each group; decontamination drops documents with benchmark items;
mixing thins out domains to their target weights; the last stage writes token
files and gives what they hold.

A row without a doc_id passes the stages that name documents by it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.chosen_path import near_duplicate_groups
from ledgermill.llm.language import held_out, keep_languages, train_language_model
from ledgermill.llm.latent import contaminated
from ledgermill.llm.mixing import copies, mix_documents
from ledgermill.llm.token_files import read_token_files, write_token_files
from ledgermill.sources.paths import fresh_folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text goes if its main language has a smaller share of its letters.
LEAST_LANGUAGE_SHARE = 0.4
TARGET_WEIGHTS = {"clean": 0.93, "poor": 0.07, "toxic": 0.0}
END_ID = 1


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents other than those of the frame of ids; the ids are stored first, so their size is known."""
    gone = stored(ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are NULL, have no letter or are mostly of no known language go."""
    model = train_language_model(docs.where(~held_out("doc_id", 4, 2)))
    return keep_languages(docs, model, LEAST_LANGUAGE_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of similar texts stays, in one row."""
    groups = near_duplicate_groups(docs, words_per_shingle=5, threshold=0.8)
    left = without(docs, groups.where(~F.col("kept")))
    repeated = stored(
        docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return left
    # Rows that repeat an id: one of each text stays.
    again = left.join(repeated, "doc_id", "left_semi").select(docs.columns)
    order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")
    first = again.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(docs.columns)
    return without(left, repeated).union(first)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or as a paraphrase, go."""
    return without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays with its rate as probability; rates bring the domains to the target weights."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated, _ = mix_documents(docs, labels, TARGET_WEIGHTS, most=1.0)
    return without(docs, rated.where(copies("rate", "doc_id") == 0))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in files, and from these doc_id, start, n_tokens and ids_crc32."""
    folder = fresh_folder(spark, "tokens")
    write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_token_files(spark, folder)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: Trained models, hashed sketches and byte formats have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
