"""Scores of an unbounded table of units: the same contract, event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.operators.contract import SCORE, Contract
from assayworks.operators.scoring import score_units


def windowed_scores(units: DataFrame, contract: Contract, time: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """``start, end, value, total_units, scored_units`` a window; rows later than ``late`` are left to the watermark.

    Row scoring keeps no state; what a window keeps is four sums, whatever its rows.
    """
    scored = score_units(units.withWatermark(time, late), contract)
    weight = F.when(F.col(SCORE).isNotNull(), F.col("input_query_count") if contract.weighted else F.lit(1))
    made = scored.groupBy(F.window(time, window)).agg(
        F.sum(F.col(SCORE) * weight).alias("s"), F.sum(weight).alias("w"), F.count("*").alias("total_units"), F.count(SCORE).alias("scored_units")
    )
    return made.select("window.start", "window.end", F.try_divide("s", "w").alias("value"), "total_units", "scored_units")
