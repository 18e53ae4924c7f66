"""Tables that are costly to make and fit to be used again: kept under a fingerprint of what they were made from.

The key of a table covers the files of its inputs (path, size, time of change) and its parameters, so changed inputs or parameters never meet an
old table. A table is written to a folder of its own, and a marker that names this folder is written last: a job that dies before
leaves nothing that would be read, and of two jobs that make the same table at the same time either result is whole.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from textkg.session import reclaim, shared_dir

_MARKER = "_made"


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of all files at or below the paths, in order."""
    out = []
    for path in paths:
        place, files = _path(spark, path)
        listed = files.listFiles(place, True)
        while listed.hasNext():
            status = listed.next()
            out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def fingerprint(spark: SparkSession, paths: Sequence[str], parameters: Mapping[str, object]) -> str:
    said = json.dumps([input_files(spark, paths), parameters], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()


def kept_table(
    spark: SparkSession, name: str, inputs: Sequence[str], parameters: Mapping[str, object], make: Callable[[], DataFrame]
) -> DataFrame:
    """The table `make()` gives for these inputs and parameters, made at most once as long as neither changes."""
    home = f"{shared_dir(spark)}/kept/{name}-{fingerprint(spark, inputs, parameters)}"
    marker, files = _path(spark, f"{home}/{_MARKER}")
    if not files.exists(marker):
        folder = f"table-{uuid.uuid4().hex}"
        make().write.parquet(f"{home}/{folder}")
        # create() replaces a marker that another job has set in the meantime; both name a whole table
        stream = files.create(marker, True)
        stream.writeBytes(folder)
        stream.close()
        reclaim(spark)
    stream = files.open(marker)
    folder = bytes(stream.readNBytes(1 << 10)).decode()
    stream.close()
    return spark.read.parquet(f"{home}/{folder}")
