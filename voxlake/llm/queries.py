"""Registered queries of this subpackage: thin applications of each operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import collocations, decontaminate, embeddings, html_text, language, licenses, packing, repeats, sentencepieces, simhash, spellings, tokenstore, toxicity
from voxlake.llm.common import table
from voxlake.plans.register import in_own_session


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepieces.encode_decode(table(spark, sf_dir, "documents"), model, with_ids=False).drop("ids", "decoded")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files `source/<doc_id div 50>/<doc_id>`: a repository of folders for each source."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.col("source"), F.lit("/"), F.floor(F.col("doc_id") / 50), F.lit("/"), F.col("doc_id"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"), ["doc_id"])


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenstore.store_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")


QUERIES = {f.__name__: in_own_session(f) for f in (op1_sentencepiece, op2_embedding_near_dedup, op3_suffix_array_dedup, op4_html_extraction, op5_license_scan, op6_token_id_output, op7_simhash_near_dedup, op8_toxicity, op9_benchmark_decontamination, op10_language_id, op11_spelling_variants, op12_phrase_collocations, op13_packing)}
ORACLES = {"op11_spelling_variants": spellings.ORACLE, "op12_phrase_collocations": collocations.ORACLE, "op5_license_scan": licenses.oracle("documents", "doc_id", "source || '/' || (doc_id // 50) || '/' || doc_id")}
