"""The ``opN_<name>`` queries, thin forms of the operators of this subpackage,
and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treepref.llm import (
    bpe, collocations, htmltext, huffman, importance, licenses, neardup, packing, pii, quality, sketch, sql, tokens, toxicity, warc)
from treepref.session import scratch_path, table


#: Key of the registered query's surrogates; a user passes a secret one.
PII_KEY = "treepref"


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on all machines."""
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_huffman_ids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "huffman")
    huffman.write_archive(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end=2, vocab=49408)
    return huffman.read_archive(spark, folder)


@register("op2_nnpu_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))) % 5
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training=fold("id") != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op3_host_suffix_array")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


@register("op4_pii_surrogates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count="n_replaced")


@register("op5_scaled_sketch")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


@register("op6_two_tier_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      digests=True)


@register("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_quality(table(spark, sf_dir, "documents"))


@register("op8_minhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@register("op9_nnls_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end=0, window=1024, cache=tokens.CACHE)


@register("op10_zstd_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warcs(table(spark, sf_dir, "pages"), folder)
    return warc.read_warcs(spark, folder)


@register("op11_debruijn_collocations", sql.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op12_importance_resampling", sql.RESAMPLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_license_diagonals", sql.licenses(licenses.NOTICES))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))
