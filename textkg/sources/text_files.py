"""Text sources and sinks: whole files, lines, word lists, token files, delimited rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textkg.functions.text import base_name
from textkg.session import broadcast_if_small, cut_lineage

TOKEN_SCHEMA = "surface string, lemma string, pos string"


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, text), one row per file; partition columns of the folder are kept."""
    files = spark.read.text(path if isinstance(path, str) else list(path), wholetext=True)
    return files.select("*", base_name(F.col("_metadata.file_path")).alias("file")).withColumnRenamed("value", "text")


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value), one row per line of one or several paths."""
    return spark.read.text(path if isinstance(path, str) else list(path), lineSep="\n")


def _at_places(lines: DataFrame, weight: Column, name: str) -> DataFrame:
    """Add the sum of `weight` over all earlier lines of the file.

    Inside a split the order of reading gives it, and a split has a bounded size; the sums of whole splits, one row each, give where it starts.
    """
    # written once, as the number of a row holds for one reading only
    lines = cut_lineage(lines.withColumn("__n", weight.cast("bigint")))
    split = ["path", "start"]
    earlier = Window.partitionBy(*split).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*split).agg(F.sum("__n").alias("__all"))
    above = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut_lineage(splits.select(*split, F.coalesce(F.sum("__all").over(above), F.lit(0)).alias("__base")))
    inside = lines.withColumn("__in", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    placed = inside.join(broadcast_if_small(bases), split)
    return placed.withColumn(name, F.col("__in") + F.col("__base")).drop("__n", "__in", "__base", "__at")


def _split_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, path, start, __at, value): lines, the start of their split, and the order of reading inside it."""
    return read_lines(spark, path).select(
        base_name(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("__at"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )


def read_numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, path, line, value): `line` counts the lines of each file from 0, also where a file is read in many splits."""
    return _at_places(_split_lines(spark, path), F.lit(1), "line").drop("start")


def read_word_list(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, ord, word): a line holds one word or several parted by commas; `ord` is the place in the file, from 0.

    Files may be read in any number of splits. Empty words have no place.
    """
    lines = _split_lines(spark, path).withColumn("words", F.filter(F.split("value", ","), lambda w: w != "")).drop("value")
    placed = _at_places(lines, F.size("words"), "first")
    return placed.select("file", "first", F.posexplode("words").alias("at", "word")).select("file", (F.col("first") + F.col("at")).alias("ord"), "word")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines `word lemma POS`; quotes are ordinary characters."""
    return spark.read.schema(TOKEN_SCHEMA).csv(path, sep=" ", quote="")


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Comma rows of an earlier stage; name fewer columns than the file has to leave out trailing tags."""
    return spark.read.schema(schema).csv(path, escape='"')


def write_rows(df: DataFrame, path: str, sep: str = ",", single_file: bool = False, quoted: bool = False) -> None:
    """Delimited rows. `single_file` is for small results: it moves everything through one task.

    Without `quoted` values are written as they are, and one that holds the separator shifts the columns behind it; with it such
    values are quoted. The empty text is read back as null. A line end inside a value is not kept together by `read_rows`.
    """
    if quoted:
        rows = df.coalesce(1) if single_file else df
        rows.write.csv(path, sep=sep, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    lines = df.select(line.alias("value"))
    (lines.coalesce(1) if single_file else lines).write.text(path, lineSep="\n")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path, lineSep="\n")
