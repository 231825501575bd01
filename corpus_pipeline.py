"""The corpus pipeline: documents to a tokenised, mixed training corpus.

Toxic documents go, one document of each group of near copies stays, documents
contaminated by the benchmark go, the sources are mixed to their target
weights, and the mix is written as token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.decontamination import decontaminate
from stockflow.llm.jaccard_join import jaccard_groups
from stockflow.llm.mixing import mix_plan, mixed
from stockflow.llm.token_output import tokenize_documents
from stockflow.llm.toxicity import score_toxicity
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_50k.json"
KEY = "__key"
NEAR = {"shingle": 5, "percent": 80}  # words, and hundredths of similarity
# A trained classifier and hashed draws take part: tested stage by stage instead.
ORACLE_SQL: str | None = None


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that only rows of the same id and text share."""
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.col("text")).alias("text"))
    return docs.select(*COLUMNS).withColumn(KEY, key)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = score_toxicity(docs, labels, keep=tuple(COLUMNS[1:]))
    return scores.filter("predicted = 0").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    docs = keyed(docs)
    groups = materialize(jaccard_groups(docs, id_col=KEY, **NEAR), "groups")
    others = groups.filter("doc_id != component_id").select(F.col("doc_id").alias(KEY))
    kept = join_lookup(docs, others.distinct(), [KEY], "left_anti")
    # Equal rows have one key: of those one stays too.
    twice = groups.filter("doc_id = component_id and n_shingles > 0").groupBy("doc_id").count()
    twice = materialize(twice.filter("count > 1").select(F.col("doc_id").alias(KEY)), "twice")
    if not twice.isEmpty():
        once = join_lookup(kept, twice, [KEY], "left_semi", written=True).dropDuplicates([KEY])
        kept = join_lookup(kept, twice, [KEY], "left_anti", written=True).union(once)
    return kept.select(*COLUMNS)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the rule allows."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = keyed(docs)
    found = decontaminate(docs, benchmark, id_col=KEY).filter("contaminated")
    found = found.select(F.col("doc_id").alias(KEY)).distinct()
    return join_lookup(docs, found, [KEY], "left_anti").select(*COLUMNS)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time it takes a document."""
    plan = mix_plan(docs, keep=tuple(COLUMNS))
    return mixed(plan, COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written, read back and digested."""
    return tokenize_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", not_contaminated),
    ("mixing sources to target weights", mixed_to_weights),
    ("token-ID output", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
