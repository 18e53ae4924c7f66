"""Per-key value lists whose rows stay bounded, however hot a key is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.session import cut_lineage

MAX_LIST = 100_000


def key_lists(df: DataFrame, key: str, value: str, max_list: int = MAX_LIST) -> DataFrame:
    """(key, part, values): the sorted values of each key in chunks of `max_list`.

    `part` is a value's position in the order of its key, divided by `max_list`, whatever the size of the key. Copies of
    a value travel as one counted row. Positions come from range partitions: a sum inside each range plus the key's total in the
    ranges before, of which there is one row per key and range; so no task meets a whole key.
    """
    counted = df.groupBy(key, value).agg(F.count("*").alias("__copies"))
    ranged = cut_lineage(counted.repartitionByRange(key, value).withColumn("__range", F.spark_partition_id()))
    until = Window.unboundedPreceding, -1
    inside = F.sum("__copies").over(Window.partitionBy("__range", key).orderBy(value).rowsBetween(*until))
    totals = ranged.groupBy(F.col(key).alias("__key"), "__range").agg(F.sum("__copies").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__range").rowsBetween(*until))
    totals = totals.select("__key", "__range", F.coalesce(before, F.lit(0)).alias("__before"))
    placed = ranged.withColumn("__inside", F.coalesce(inside, F.lit(0)))
    placed = placed.join(totals, F.col(key).eqNullSafe(F.col("__key")) & (placed["__range"] == totals["__range"]))
    first = F.col("__before") + F.col("__inside")
    last = first + F.col("__copies") - 1
    parts = placed.select(
        key, F.col(value).alias("v"), first.alias("__first"), last.alias("__last"),
        F.explode(F.sequence(F.floor(first / max_list), F.floor(last / max_list))).alias("part"),
    )
    times = F.least("__last", (F.col("part") + 1) * max_list - 1) - F.greatest("__first", F.col("part") * max_list) + 1
    gathered = parts.select(key, "part", F.struct("v", times.cast("int").alias("times")).alias("run")).groupBy(key, "part").agg(
        F.sort_array(F.collect_list("run")).alias("__runs")
    )
    return gathered.select(
        key, "part", F.flatten(F.transform("__runs", lambda r: F.array_repeat(r["v"], r["times"]))).alias("values")
    )


def cogroup_lists(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, max_list: int = MAX_LIST
) -> DataFrame:
    """(key, part, left_values, right_values) for every key of either side; a missing side is an empty list."""
    a = key_lists(left, key, left_value, max_list).withColumnRenamed("values", "left_values")
    b = key_lists(right, key, right_value, max_list).withColumnRenamed("values", "right_values")
    both = a.join(b, [key, "part"], "full_outer")
    return both.select(
        key,
        "part",
        *[F.coalesce(F.col(c), F.array().cast(both.schema[c].dataType)).alias(c) for c in ("left_values", "right_values")],
    )
