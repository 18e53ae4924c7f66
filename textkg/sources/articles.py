"""Article XML and id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.functions.text import base_name, squeeze

ARTICLE_SCHEMA = (
    "MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,"
    "Abstract:struct<AbstractText:array<struct<_Label:string,_VALUE:string>>>>>"
)

SEARCH_SCHEMA = "Count bigint, IdList struct<Id:array<string>>, QueryTranslation string"


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, title, sections ARRAY<STRING>), sections in file order, null without an abstract."""
    articles = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(ARTICLE_SCHEMA).load(path)
    return articles.select(
        F.col("MedlineCitation.PMID").alias("pmid"),
        F.col("MedlineCitation.Article.ArticleTitle").alias("title"),
        F.col("MedlineCitation.Article.Abstract.AbstractText._VALUE").alias("sections"),
    )


def abstract_text(articles: DataFrame) -> DataFrame:
    """(pmid, abstract): all sections, joined without a separator."""
    return articles.select("pmid", F.coalesce(F.array_join("sections", ""), F.lit("")).alias("abstract"))


def title_abstracts(articles: DataFrame, order: Column) -> DataFrame:
    """(title, abstract): the first section per title, white space squeezed; of equal titles the last by `order` stands."""
    made = articles.select(
        squeeze(F.col("title")).alias("title"),
        squeeze(F.get("sections", F.lit(0)), "").alias("abstract"),
        order.alias("__order"),
    )
    # the abstract is wrapped, as a null one also replaces an earlier one
    last = made.groupBy("title").agg(F.max_by(F.struct("abstract"), "__order").alias("__last"))
    return last.select("title", "__last.abstract")


def id_list(xml: Column) -> Column:
    """ARRAY<STRING> of the ids in a search result."""
    return F.xpath(xml, F.lit("//IdList/Id/text()"))


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """(file, term, total, ord, id) of stored search results: each id with its place in its result, from 0.

    A file holds one result, or several below a root element. `term` is the query as the service understood it, `total` how many ids it has in all; both are null
    where the result doesn't say. A result without ids has no rows.
    """
    found = spark.read.format("xml").option("rowTag", "eSearchResult").schema(SEARCH_SCHEMA).load(path)
    return found.select(
        base_name(F.col("_metadata.file_path")).alias("file"), F.col("QueryTranslation").alias("term"), F.col("Count").alias("total"),
        F.posexplode("IdList.Id").alias("ord", "id"),
    )
