"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import near_duplicates, packing, phrases, quality, substrings
from tradeflow.llm.text import free_names
from tradeflow.workspace import new_folder, settled

TOKENIZER = "word_bpe_49k.json"

# No stage but the first is a query of plain SQL; tests hold the whole against brute force.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects go on."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies goes on: that of the least id."""
    return near_duplicates.one_of_each_class(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; a document of which no word is left goes."""
    own = [c for c in docs.columns if c.lower() in ("n_words", "n_removed", "kept_text")]  # names the operator gives
    aside = dict(zip(own, free_names(docs.columns, *[f"_own_{c}" for c in own]), strict=True))
    cut = substrings.without_repeats(docs.withColumnsRenamed(aside), rewrite=True)
    left = cut.where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    left = left.withColumn("text", F.col("kept_text")).withColumn(
        "n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a phrase of a benchmark item go."""
    return phrases.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), new_folder(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
