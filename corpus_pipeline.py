"""From raw documents to packed windows of token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's input. All stages but the last
return the columns of `documents`; rows with null or empty texts pass the toxicity filter, are dropped as texts without a
letter by language identification, and so on as the operators state.

Documents travel whole between Spark and the workers, so stages bound the Arrow batches of their session by bytes (`BATCH_BYTES`): 10,000 long
rows at once would be held several times over in both. A smaller setting of the session stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.llm import langid, ngram_join, packing, suffix_dedup, toxicity
from textkg.llm.queries import vocabulary_path
from textkg.session import cut_lineage

BATCH_BYTES = 6 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    now = spark.conf.get(_BATCH_KEY)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > limit:
        spark.conf.set(_BATCH_KEY, str(limit))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    bound_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter go."""
    bound_batches(spark)
    return langid.drop_unknown_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    bound_batches(spark)
    return ngram_join.keep_one_of_each_group(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by repeated strings of 200 bytes go from the texts; n_chars follows."""
    bound_batches(spark)
    kept = suffix_dedup.remove_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    bound_batches(spark)
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("packing", pack),
]

# SQL can state none of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
