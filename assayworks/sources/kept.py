"""Tables that are worked out once: written to the folder that driver and executors share, and read back.

A written table cuts lineage and survives the loss of executors, and whoever reads
it twice reads the same rows in the same partitions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_noted: ContextVar[list[DataFrame] | None] = ContextVar("noted", default=None)


@contextmanager
def noting() -> Iterator[list[DataFrame]]:
    """The tables that are kept meanwhile, so that what a run doesn't need any more can be deleted."""
    made: list[DataFrame] = []
    before = _noted.set(made)
    try:
        yield made
    finally:
        _noted.reset(before)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; without it a local session (a test) gets a folder of its own, a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="assayworks-")
        found = _own[app]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/assayworks-{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder with anything in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]


def kept(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write a table and read it back; ``by``: columns that name the folders of its parts, which a filter on them reads alone."""
    spark, schema = df.sparkSession, df.schema
    path = fresh_path(spark, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._shared_path = path
    if (made := _noted.get()) is not None:
        made.append(out)
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete the files of tables made by :func:`kept` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_shared_path", None)
        if path is None:
            continue
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scanned(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Add sums over all rows before each one in an order that no two rows share.

    Range partitions are summed within, and carried over by the sums of the partitions before; no task sees all rows.
    """
    ranged = kept(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    parts = ranged.groupBy("_range").agg(*(F.sum(e).alias(f"_{c}") for c, e in sums.items()))
    carry = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    before = parts.select("_range", *(F.coalesce(F.sum(f"_{c}").over(carry), F.lit(0)).alias(f"_{c}") for c in sums))
    own = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    added = ranged.join(F.broadcast(before), "_range")
    out = added.withColumns({c: F.col(f"_{c}") + F.coalesce(F.sum(e).over(own), F.lit(0)) for c, e in sums.items()})
    out = out.drop("_range", *(f"_{c}" for c in sums))
    out._reads = [ranged]
    return out


def placed(df: DataFrame, by: str, order: list[Column], out: str) -> DataFrame:
    """Number the rows of each group from 1 in an order that no two rows of it share, a group's rows over as many tasks as they need.

    Rows are range partitioned by group and order; a partition's rows of a group are numbered from the count of those before it.
    """
    ranged = kept(df.repartitionByRange(F.col(by), *order).withColumn("_range", F.spark_partition_id()), "placed")
    sizes = ranged.groupBy(by, "_range").agg(F.count("*").alias("_n"))
    carry = W.partitionBy(by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    before = sizes.select(F.col(by).alias("_by"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(carry), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_range", by).orderBy(*order))
    held = ranged.withColumn("_own", own).join(before, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_at")))
    return held.withColumn(out, (F.col("_before") + F.col("_own")).cast("long")).drop("_range", "_own", "_by", "_at", "_before")


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number rows from 0 by columns that order them, without one task sorting all: offsets of written range partitions."""
    ranged = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_m", 33)
    sizes = ranged.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_s"))  # a row for each partition
    held = ranged.join(F.broadcast(starts), part == F.col("_p"))
    return held.withColumn(out, (F.col("_s") + F.col("_m").bitwiseAND((1 << 33) - 1)).cast("long")).drop("_m", "_p", "_s")
