"""A file of one row group is spread over the cores, also when it is long enough for many splits."""

import pytest
from pyspark.sql import functions as F

from textkg.session import spread


def full_partitions(df):
    return df.select(F.spark_partition_id()).distinct().count()


@pytest.fixture
def one_group(spark, tmp_path):
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    path = str(tmp_path / "one")
    rows.coalesce(1).write.parquet(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", held[0])
    spark.conf.set("spark.sql.files.openCostInBytes", held[1])


def test_empty_splits_do_not_count(spark, one_group):
    cores = spark.sparkContext.defaultParallelism
    assert one_group.rdd.getNumPartitions() >= cores and full_partitions(one_group) == 1
    assert full_partitions(spread(one_group)) >= cores
    assert sorted(spread(one_group).collect()) == sorted(one_group.collect())


def test_full_splits_pass_unchanged(spark):
    cores = spark.sparkContext.defaultParallelism
    full = spark.range(0, 1000, 1, 2 * cores)
    assert spread(full).rdd.getNumPartitions() == 2 * cores and "Exchange" not in spread(full)._jdf.queryExecution().toString()
