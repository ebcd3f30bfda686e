"""A corpus-cleaning pipeline: each stage applies one operator to all that the stage before it kept.

Stages take (spark, docs, sf_dir).  All but the last return the columns of documents, whatever other columns docs has; rows with a null doc_id
take part where an operator can treat them and are otherwise kept.  Rows that repeat a doc_id are one document for decisions (all stay or
all go); their texts are treated each by itself.  Null and empty texts stay, unless they are copies of each other.  An empty table gives an
empty result.  Every decision takes effect on what the next stage reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import decontaminate, repeats, sentencepieces, simhash, toxicity
from voxlake.plans.scratch import saved
from voxlake.plans.workers import small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROWS = 1_000  # texts that travel to a Python worker at once


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose doc_id is not among gone; rows without doc_id stay.

    What goes is found first, by itself: no executor holds whole rows for this join while its Python workers are at an operator's work."""
    ids = saved(gone.select("doc_id").where("doc_id is not null").distinct(), "pipeline-gone")
    return docs.select(*COLUMNS).join(ids, "doc_id", "left_anti").select(*COLUMNS)


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that it predicts to be toxic go.  All labels but those it holds out are learned."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with small_batches(docs.sparkSession, ROWS):
        scored = toxicity.toxicity(docs.select("doc_id", "text"), labels)
        return _without(docs, scored.where("predicted = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group the document with the smallest doc_id stays.  Fingerprints link, and five-word shingles at a similarity of 0.8."""
    with small_batches(docs.sparkSession, ROWS):
        found = simhash.near_duplicates(docs.select("doc_id", "text"), similarity=0.8)
        return _without(docs, found.where("doc_id <> component_id"))


def unrepeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: repeated bytes go, and with them documents of which nothing is left."""
    rows = docs.select(*COLUMNS).withColumn("no_text", F.col("text").isNull())
    with small_batches(docs.sparkSession, ROWS):
        cut = repeats.remove_repeats(rows, carry=("lang", "source", "n_chars", "no_text"))
    changed = F.col("n_removed") > 0
    cut = cut.where(~changed | (F.length(F.trim("kept")) > 0))
    text = F.when(~F.col("no_text"), F.col("kept"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a passage of a test item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with small_batches(docs.sparkSession, ROWS):
        return _without(docs, decontaminate.leaks(docs.select("doc_id", "text"), benchmark))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the piece ids of each text, with the check that decoding gives the text back."""
    import public_tokenizers

    model = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepieces.encode_decode(docs.select("doc_id", "text"), model).select("doc_id", "ids", "n_tokens", "ids_crc32", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_language),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", unrepeated_text),
    ("benchmark_decontamination", without_test_items),
    ("sentencepiece", token_ids),
]
ORACLE_SQL = None  # no stage is expressible in SQL; tests compare each with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"pipeline-{name}")
    return docs
