"""Session defaults, the shared scratch folder and lineage cutting."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# Folders made for sessions without the setting, by application id.
_own_dirs: dict[str, str] = {}


def build_session(app: str = "textkg", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    A local master without that setting (tests) gets a folder of this application below the warehouse, which Hadoop's file
    system makes and removes when the application ends. A cluster without it is an error, as its default warehouse may lie on
    one machine.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/textkg-{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own_dirs[app] = path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()
    return _own_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for files one job writes and a later one reads."""
    return os.path.join(shared_dir(spark), "scratch", f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to a table in the shared folder and read it back.

    Iterative plans stay short, work used by several branches is done once, lost executors cost nothing that was written,
    and later joins see column pruning and real sizes.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that `cut_lineage` wrote, once everything read from them is written itself.

    Nothing that still has to be computed, or computed again after a loss, may depend on them.
    """
    for df in tables:
        spark = df.sparkSession
        scratch = os.path.join(shared_dir(spark), "scratch", "cut-")
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            own = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(scratch)).toString()
            if files.makeQualified(path).toString().startswith(own):
                files.delete(path, True)


def reclaim(spark: SparkSession) -> None:
    """Have the files of exchanges that nothing refers to any more deleted now.

    Spark deletes them when the driver's garbage collection finds their plans gone, which a driver with free memory may not see for the whole
    job; call this between the steps of a loop, after the result of a step is written.
    """
    gc.collect()
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan only when fewer of its splits hold rows than the cluster has cores.

    Large inputs already have many splits and pass unchanged; a small file with heavy per-row work would otherwise
    run in one task. So would a large file of few row groups, as all but those splits are empty in which a row group has its middle; these
    are counted from the files' footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    full = splits if splits < cores else df.select(F.spark_partition_id().alias("split")).distinct().count()
    return df.repartition(max(cores, splits)) if full < cores else df


def deal(df: DataFrame) -> DataFrame:
    """Deal rows evenly over all tasks of a shuffle.

    For few bytes of rows with much work each: adaptive execution would put what comes out of a shuffle into one task by its size.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression runs once per row.

    A plain projection may be merged into every later use, also below a filter or inside a lambda, and be evaluated
    again there; a one-element generator is not merged.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """An upper estimate of the size of a row in a hash table, for flat rows."""
    width = F.lit(32)
    for f in df.schema.fields:
        width = width + (F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() == "string" else F.lit(16))
    return width.cast("bigint")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint when its measured size is below `limit`, else `df` as it is.

    The measure is one aggregate over `df`, so call this on sides that are cheap to compute or already materialized. Beyond
    the limit the join shuffles, and AQE splits its skewed partitions.
    """
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df
