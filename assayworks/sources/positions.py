"""Row positions of tables that have none: the order of files, and of rows in a file.

A position is dense, from 0, and a row's own whatever partitions and splits it is read
in.  Parquet rows have their place in the file; rows of other files are kept once with
the start of their split and their order in it.  Rows of each file (and split) are counted and
scanned into offsets, over ranges of files; rows themselves aren't sorted or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.sources.kept import kept, scanned

#: Offsets are broadcast up to so many files or splits, and joined by shuffle beyond.
BROADCAST_FILES = 100_000


def _dense(rows: DataFrame, pieces: DataFrame, keys: list[str], within: Column, out: str) -> DataFrame:
    """Add positions: the offset of a row's piece and its place within; ``pieces(*keys, _first, _n)``."""
    starts = scanned(pieces, [F.col(k) for k in keys], {"_start": F.col("_n")}, "pieces").select(*keys, "_first", "_start")
    starts = kept(starts, "starts")
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_FILES else starts
    return rows.join(starts, keys).withColumn(out, (F.col("_start") + within - F.col("_first")).cast("long")).drop(*keys, "_first", "_start", "_place")


def of_parquet(spark: SparkSession, path: str, out: str = "_pos") -> DataFrame:
    """A Parquet table with positions: files by their paths, rows by their place in the file; nothing is written but offsets."""
    plain = spark.read.parquet(path)
    if out in plain.columns:
        return plain
    rows = plain.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    pieces = rows.groupBy("_file").agg(F.lit(0).cast("long").alias("_first"), F.count("*").alias("_n"))
    return _dense(rows, pieces, ["_file"], F.col("_place"), out)


def of_text(read: DataFrame, out: str = "_pos") -> DataFrame:
    """A table of text files (CSV and the like) as it comes from ``spark.read``, kept as Parquet, with positions."""
    if out in read.columns:
        return read
    marked = read.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_place")
    )
    rows = kept(marked, "rows")
    pieces = rows.groupBy("_file", "_split").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    return _dense(rows, pieces, ["_file", "_split"], F.col("_place"), out)


def of_frame(df: DataFrame, out: str = "_pos") -> DataFrame:
    """Any other frame, kept in the order in which its partitions come."""
    if out in df.columns:
        return df
    rows = kept(df.select("*", F.monotonically_increasing_id().alias("_place")).withColumn("_part", F.shiftright("_place", 33)), "rows")
    pieces = rows.groupBy("_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    return _dense(rows, pieces, ["_part"], F.col("_place"), out)
