"""Term frequency and inverse document frequency.

Term frequencies are run lengths of each document's sorted terms, found inside its row. Per-term results need one
aggregation: document frequency and the wanted term frequency come out of the same pass, so nothing is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.functions.text import counted


def term_frequency(docs: DataFrame, terms: str = "words") -> DataFrame:
    """(doc_id, term, tf) from (doc_id, ARRAY of terms)."""
    return docs.select("doc_id", F.inline(counted(F.col(terms))).alias("term", "tf"))


def idf_of(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1))


def n_documents(docs: DataFrame) -> Column:
    """The number of documents as a scalar subquery.

    Give the functions below the count of the plain document table: counting a table of prepared terms prepares them again.
    """
    return docs.agg(F.count("*")).scalar()


def _total(docs: DataFrame, n_docs: Column | None) -> Column:
    return n_documents(docs) if n_docs is None else n_docs


def inverse_document_frequency(docs: DataFrame, terms: str = "words", n_docs: Column | None = None) -> DataFrame:
    """(term, df, idf)."""
    seen = docs.select(F.explode(F.array_distinct(terms)).alias("term"))
    return (
        seen.groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("idf", idf_of(_total(docs, n_docs), F.col("df")))
    )


def tfidf(docs: DataFrame, terms: str = "words", n_docs: Column | None = None) -> DataFrame:
    """(doc_id, term, tf, score) of every document term.

    The join has one row per term on the frequency side, so AQE can split a term that is in most documents.
    """
    weights = inverse_document_frequency(docs, terms, n_docs).select("term", "idf")
    return (
        term_frequency(docs, terms)
        .join(weights, "term")
        .select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("score"))
    )


def term_scores(
    docs: DataFrame, terms: str = "words", keep: str = "max", n_docs: Column | None = None
) -> DataFrame:
    """(term, df, score): the best score of a term, or with keep='last' its score in the last document holding it."""
    tf = F.max("tf") if keep == "max" else F.max_by("tf", "doc_id")
    per_term = term_frequency(docs, terms).groupBy("term").agg(F.count("*").alias("df"), tf.alias("tf"))
    return per_term.select(
        "term", "df", (F.col("tf") * idf_of(_total(docs, n_docs), F.col("df"))).alias("score")
    )


def token_rarity(words: DataFrame) -> DataFrame:
    """(word, n, score) when every token counts as a document of its own: ln((total + 1) / (n + 1))."""
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("score", F.log((total + 1) / (F.col("n") + 1)))


def bucket_of(term: Column) -> Column:
    """One of 2^20 buckets: the first five hex digits of the term's MD5."""
    return F.conv(F.left(F.md5(term.cast("binary")), F.lit(5)), 16, 10).cast("bigint")


def hashed_scores(docs: DataFrame, terms: str = "words", n_docs: Column | None = None) -> DataFrame:
    """(term, bucket, score) by hash bucket: terms of a bucket share counts, and the last document's score stands.

    Bucket counts of a document come from its own row; colliding terms meet in the join on bucket.
    """
    buckets = F.transform(F.col(terms), bucket_of)
    per_doc = docs.select("doc_id", F.inline(counted(buckets)).alias("bucket", "tf"))
    per_bucket = per_doc.groupBy("bucket").agg(
        F.count("*").alias("df"), F.max_by("tf", "doc_id").alias("tf")
    )
    scored = per_bucket.select(
        "bucket", (F.col("tf") * idf_of(_total(docs, n_docs), F.col("df"))).alias("score")
    )
    vocabulary = (
        docs.select(F.explode(F.array_distinct(terms)).alias("term")).distinct().withColumn("bucket", bucket_of(F.col("term")))
    )
    return vocabulary.join(scored, "bucket").select("term", "bucket", "score")
