"""Where intermediate tables live, and small helpers that several operators use.

Intermediate tables are written below ``spark.checkpoint.dir``, the folder that
driver and executors share.  A written table cuts lineage and survives the loss
of executors.  Operators delete the tables that their result doesn't read;
:func:`release` deletes the others once the result has been used.  Without that
setting a local session (a test) gets a folder of its own, a cluster an error.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.sources.kept import forget, fresh_path, shared_dir

__all__ = ["as_text", "forget", "fresh_path", "reading", "release", "settings", "shared_dir", "table", "tidy", "written"]

#: While a table is written: what goes to Python at a time, and small partitions put together up to the session's advisory size, 16 MB at least.
_ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_LEAST_ADVISORY = 16 << 20


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str, few: bool = True) -> DataFrame:
    """Write a table to the shared folder and read it back; texts go to Python in small batches meanwhile.

    ``few``: no more files than their size asks for; else as many tasks as there are, for work that is more than its rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    told = dict(_ARROW)
    if few:
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ADVISORY))
        told |= {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", _ADVISORY: str(max(size, _LEAST_ADVISORY))}
    with settings(spark, told):
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._shared_path = path
    return out


def reading(out: DataFrame, *tables: DataFrame | None) -> DataFrame:
    """Note which written tables a result reads, for :func:`release`."""
    out._reads = [*getattr(out, "_reads", []), *tables]
    return out


def release(out: DataFrame) -> None:
    """Delete the intermediate tables of an operator's result; it can't be evaluated afterwards."""
    for df in getattr(out, "_reads", []):
        if df is not None:
            release(df)
    forget(out)


def tidy() -> None:
    """In a Python worker, at the end of a task: give memory back to the system."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(c: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(c, F.lit(""))
