"""Row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.session import cut_lineage


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, ... in the order of `order`, which must identify a row.

    Rows are range-partitioned, numbered inside each range, and shifted by the sizes of the ranges before. The ranges are
    checkpointed first: their bounds come from a sample and must be the same for both passes.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = cut_lineage(
        df.repartitionByRange(partitions, *order).withColumn("__range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    # at most `partitions` rows, so one task and a broadcast are safe here
    before = sizes.select(
        "__range",
        F.coalesce(
            F.sum("__n").over(
                Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("__before"),
    )
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return (
        ranged.withColumn("__local", local)
        .join(F.broadcast(before), "__range")
        .withColumn(name, F.col("__before") + F.col("__local"))
        .drop("__range", "__local", "__before")
    )


def batches(df: DataFrame, id_col: str, size: int, cap: int | None = None) -> DataFrame:
    """(batch, n_ids, ids): ids in order, `size` per batch, joined by commas; `cap` stops after that many ids."""
    numbered = with_ordinal(df.select(id_col), [id_col])
    if cap is not None:
        numbered = numbered.where(F.col("ordinal") < cap)
    return (
        numbered.groupBy(F.floor(F.col("ordinal") / size).alias("batch"))
        .agg(F.count("*").alias("n_ids"), F.sort_array(F.collect_list(id_col)).alias("__ids"))
        .select("batch", "n_ids", F.array_join(F.col("__ids").cast("array<string>"), ",").alias("ids"))
    )
