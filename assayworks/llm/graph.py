"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation and an equi-join, so neither edges nor labels ever
meet on the driver or in one task.  Smallest neighbours are written before they are
joined: both sides of the join are then plain tables, and AQE splits the partition
of a node with very many neighbours.  A step ends with a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import forget, reading, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
    hung = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    out = written(hung.distinct(), "edges")
    forget(low)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = written(down.groupBy("a").agg(F.min("b").alias("m")), "low")
    hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = written(hung.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
    forget(low)
    return out


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is either a centre or hangs on just one centre."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("hung"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("hung"), F.lit(1).alias("centre"))
    )
    seen = ends.groupBy("id").agg(F.sum("hung").alias("hung"), F.max("centre").alias("centre"))
    return not seen.where("hung > 1 or (hung = 1 and centre = 1)").head(1)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs to ``(id, component)``, the smallest id reachable.

    Ids without an edge do not appear.  Self links, repeated links and either
    direction are allowed; links with a null end are left out.  An empty input
    gives an empty table.  Raises if the edges are no stars after ``most_rounds``.
    """
    now = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(most_rounds):
        if _are_stars(now):
            break
        wide = _large_star(now)
        step = _small_star(wide)
        forget(now, wide)
        now = step
    else:
        if not _are_stars(now):
            forget(now)
            raise RuntimeError(f"components: the edges are no stars after {most_rounds} rounds")
    out = now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
    return reading(out, now)
