"""Registered queries of the corpus operators over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.decontamination import decontaminate
from stockflow.llm.embedding_dedup import near_duplicates
from stockflow.llm.jaccard_join import jaccard_groups
from stockflow.llm.line_dedup import dedup_lines
from stockflow.llm.lm_scoring import score_texts
from stockflow.llm.merkle import fold, leaf_hash, merkle_manifest, siblings
from stockflow.llm.mixing import mix_plan
from stockflow.llm.quality import score_quality
from stockflow.llm.repeats import remove_repeats
from stockflow.llm.secret_scan import scan_secrets, span_text
from stockflow.llm.token_alignment import align_tokens
from stockflow.llm.token_output import tokenize_documents
from stockflow.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_token_output(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return tokenize_documents(table(spark, folder, "documents"), tokenizer)


@query
def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mix_plan(table(spark, folder, "documents"))
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("draws")).alias("taken"),
        F.transform("draws", lambda d: d["shard"]).alias("shards"),
    )


@query
def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).drop("runs")


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


@query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    docs = docs.withColumn("found", leaf_hash(*map(F.col, ("doc_id", "source", "lang")), n_chars, F.col("text")))
    rows = merkle_manifest(docs, keep=("found",))
    folded = fold(F.col("found"), F.col("proof"))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokens(table(spark, folder, "documents"), *paths)


@query
def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
