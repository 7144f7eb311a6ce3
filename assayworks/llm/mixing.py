"""Mixing sources to target weights: how often each document is taken, so that sources come near their targets.

1. Words are counted for each document and summed for each source, before any shuffle.
2. Sources in the order of their code points (null last) get weights in turn; they
   share ``share`` times all words by weight, but none gets more than ``most`` times its own:
   the excess is shared again by weight until no source is above.  With sources ordered by
   their limit over their weight, the level at which this ends is the largest of
   ``(all - limits before) / (weights from here on)``, one number.
3. A source's rate is its target over its size; each of its documents is taken ``floor(rate)``
   times, and once more if a draw by a hash of the document falls below the fraction.

Both orders of sources are range partitions with carries, so no task sees all sources.
Targets are broadcast up to ``broadcast_sources`` sources and joined by shuffle beyond, where
AQE splits a source with very many documents; the result is the same.  DataFrame functions only.

Defined cases: a null text has no words; without words a source's target and rate are 0.
Draws depend on the document's key alone (on its text where that is null), so runs agree, and
repeated rows are all taken equally often.  :func:`mix` carries input columns through under any
name; its ``copy`` replaces one of that name.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import forget, reading, written
from assayworks.sources.kept import scanned


@dataclass(frozen=True)
class Settings:
    share: float = 1.5
    most: float = 2.0
    weights: Sequence[int] = (5, 2, 1)
    seed: str = "mix"
    broadcast_sources: int = 100_000


def words(text: Column) -> Column:
    """How many words a text has: each becomes one sign, and only signs are counted, so a very long text takes its own memory once more."""
    signs = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(signs), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: str) -> Column:
    """A number from 0 to below 1, the same in every run: 52 bits of a hash."""
    known = F.coalesce(key.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), known).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sized: DataFrame, given: Settings = Settings()) -> DataFrame:
    """``source, source_size, target`` for each source of ``sized(source, size)``."""
    sums = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    numbered = scanned(sums, [F.col("source").asc_nulls_last()], {"_rank": F.lit(1)}, "sources")
    weight = F.get(F.array(*map(F.lit, given.weights)), (F.col("_rank") % len(given.weights)).cast("int"))
    limited = numbered.withColumn("_weight", weight.cast("double")).withColumn("_limit", given.most * F.col("source_size"))
    kept = written(limited, "weights")
    forget(*numbered._reads)
    ordered = scanned(kept, [F.col("_limit") / F.col("_weight"), F.col("_rank")], {"_limits": F.col("_limit"), "_weights": F.col("_weight")}, "limits")
    whole = kept.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    every = given.share * (whole["size"] or 0)
    level = ordered.agg(F.max((F.lit(every) - F.col("_limits")) / (F.lit(whole["weight"]) - F.col("_weights")))).first()[0]
    forget(*ordered._reads)
    out = kept.select("source", "source_size", F.least("_limit", F.col("_weight") * F.lit(level).cast("double")).alias("target"))
    return reading(out, kept)


def planned(sized: DataFrame, given: Settings = Settings()) -> DataFrame:
    """Add ``source_size, target, copies`` to rows with ``source, size, draw``."""
    goals = targets(sized, given)
    named = goals.withColumnRenamed("source", "_source")
    named = F.broadcast(named) if goals.count() <= given.broadcast_sources else named
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    joined = sized.drop("source_size", "target", "copies").join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return reading(joined.withColumn("copies", copies.cast("int")), *goals._reads)


def mix(docs: DataFrame, given: Settings = Settings()) -> DataFrame:
    """The mix itself: rows of ``docs(doc_id, source, text)`` as often as they are taken, with ``copy`` from 1."""
    whole = F.struct(*(F.col(c) for c in docs.columns if c != "copy")).alias("_row")
    sized = docs.select(whole, "source", words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), given.seed).alias("draw"))
    plan = planned(sized, given)
    return reading(plan.where("copies > 0").select("_row.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")), plan)


def taken(docs: DataFrame, given: Settings = Settings()) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, copies, taken``."""
    narrow = docs.select("doc_id", "source", words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), given.seed).alias("draw"))
    sized = written(narrow, "sizes")
    plan = planned(sized, given)
    out = plan.select("doc_id", "size", "source_size", "target", F.col("copies"), (F.col("size") * F.col("copies")).alias("taken"))
    return reading(out, plan, sized)
