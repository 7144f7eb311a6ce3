"""How well predictions agree with labels, per criterion and on average."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayworks.sources.kept import kept, scanned


def row_accuracy(pairs: list[tuple[str, str]]) -> Column:
    """The share of exact matches among the criteria with both values; 0 if there is none."""
    both = [F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs]
    same = [(F.col(a) == F.col(b)).cast("int") for a, b in pairs]
    n = reduce(lambda x, y: x + y, [b.cast("int") for b in both])
    hits = reduce(lambda x, y: x + y, [F.when(b, s).otherwise(0) for b, s in zip(both, same, strict=True)])
    return F.coalesce(F.try_divide(hits.cast("double"), n), F.lit(0.0))


def mean_accuracy(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``acc_auto`` and ``baseline_mode_accuracy``: against each label's mode, the smallest of equal ones."""
    modes = df.agg(*[F.mode(b, True).alias(f"_m{i}") for i, (_, b) in enumerate(pairs)])
    held = df.crossJoin(F.broadcast(modes))  # one row
    return held.agg(
        F.avg(row_accuracy(pairs)).alias("acc_auto"),
        F.avg(row_accuracy([(f"_m{i}", b) for i, (_, b) in enumerate(pairs)])).alias("baseline_mode_accuracy"),
    )


def confusion(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of the pairs of values, both present."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("n"))


def kappa_alpha(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa and Krippendorff's nominal alpha of two raters: one row, from the confusion table."""
    table = confusion(df, a, b)
    total = table.agg(F.sum("n").cast("double").alias("t"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0)).cast("double").alias("same"))
    xs = table.groupBy(F.col("x").alias("v")).agg(F.sum("n").cast("double").alias("nx"))
    ys = table.groupBy(F.col("y").alias("v")).agg(F.sum("n").cast("double").alias("ny"))
    margins = xs.join(ys, "v", "full").select(F.coalesce("nx", F.lit(0.0)).alias("nx"), F.coalesce("ny", F.lit(0.0)).alias("ny"))
    m = margins.agg(F.sum(F.col("nx") * F.col("ny")).alias("xy"), F.sum(F.pow(F.col("nx") + F.col("ny"), 2)).alias("sq"))
    t, same, n = F.col("t"), F.col("same"), 2 * F.col("t")
    po, pe = F.try_divide(same, t), F.try_divide(F.col("xy"), t * t)
    kappa = F.when(t >= 2, F.try_divide(po - pe, 1 - pe))
    alpha = F.when(t >= 2, 1 - F.try_divide((n - 1) * 2 * (t - same), n * n - F.col("sq")))
    return total.join(F.broadcast(m)).select(kappa.alias("cohen_kappa"), alpha.alias("krippendorff_alpha"))


def range_bucket(df: DataFrame, column: str, most: int = 10_000, parts: int = 256) -> Column:
    """The number of a value's range, of so many ranges of about equal size; all are 0 in a table of at most ``most`` rows.

    Bounds are literals, so every use deals rows alike.
    """
    if df.limit(most + 1).count() <= most:
        return F.lit(0)
    bounds = sorted(set(df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.25 / parts)))
    array = F.array(*map(F.lit, bounds))
    return F.size(F.filter(array, lambda b: b < F.col(column)))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation over complete pairs, ties by their average rank; null if a side is constant.

    Ranks come from the counts of distinct values, so rows are aggregated before anything is ordered.
    """
    full = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
    pairs = full.groupBy("x", "y").agg(F.count("*").alias("n"))

    def ranks(c: str) -> DataFrame:
        each = pairs.groupBy(c).agg(F.sum("n").alias("k"))
        bucket = range_bucket(each, c)
        sizes = each.groupBy(bucket.alias("b")).agg(F.sum("k").alias("s"))
        before = sizes.select("b", F.coalesce(F.sum("s").over(W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        own = W.partitionBy("b").orderBy(c).rowsBetween(W.unboundedPreceding, -1)
        below = F.col("before") + F.coalesce(F.sum("k").over(own), F.lit(0))
        return each.withColumn("b", bucket).join(F.broadcast(before), "b").select(c, (below + (F.col("k") + 1) / 2).alias(f"r{c}"))

    ranked = pairs.join(ranks("x"), "x").join(ranks("y"), "y")
    s = ranked.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("rx")).alias("sx"), F.sum(F.col("n") * F.col("ry")).alias("sy"),
        F.sum(F.col("n") * F.col("rx") * F.col("rx")).alias("xx"), F.sum(F.col("n") * F.col("ry") * F.col("ry")).alias("yy"),
        F.sum(F.col("n") * F.col("rx") * F.col("ry")).alias("xy"),
    )
    cov = F.col("n") * F.col("xy") - F.col("sx") * F.col("sy")
    var = lambda q, m: F.col("n") * F.col(q) - F.col(m) * F.col(m)
    return s.select(F.when(F.col("n") > 1, F.try_divide(cov, F.sqrt(var("xx", "sx") * var("yy", "sy")))).alias("spearman"))


def _key(c: str, numeric: bool) -> Column:
    return F.col(f"`{c}`").cast("double").cast("string") if numeric else F.col(f"`{c}`").cast("string")


def confusions(df: DataFrame, criteria: list[str]) -> DataFrame:
    """``criterion, x, y, n``: counts of the pairs of values of ``agent_<criterion>`` and ``<criterion>``, all criteria in one pass."""
    cells = []
    for c in criteria:
        numeric = all(isinstance(df.schema[k].dataType, T.NumericType) for k in (f"agent_{c}", c))
        cells.append(F.struct(F.lit(c).alias("criterion"), _key(f"agent_{c}", numeric).alias("x"), _key(c, numeric).alias("y")))
    full = F.filter(F.array(*cells), lambda p: p.x.isNotNull() & p.y.isNotNull())
    return df.select(F.explode(full).alias("p")).groupBy("p.criterion", "p.x", "p.y").agg(F.count("*").alias("n"))


def by_criterion(df: DataFrame, criteria: list[str]) -> DataFrame:
    """``criterion, pairs, cohen_kappa, krippendorff_alpha, spearman`` from one table of confusions, however many criteria there are.

    Margins of both raters come from one aggregation, ranks from sums over all margins in order.  A measure that can't be had
    (fewer than two pairs, one value only, values that are no numbers) is null; a criterion without pairs has no row.
    """
    table = kept(confusions(df, criteria), "confusions")
    sides = F.array(F.struct(F.lit("x").alias("side"), F.col("x").alias("v")), F.struct(F.lit("y").alias("side"), F.col("y").alias("v")))
    margins = table.select("criterion", "n", F.explode(sides).alias("s")).groupBy("criterion", "s.side", "s.v").agg(F.sum("n").alias("n"))
    margins = kept(margins.withColumn("value", F.col("v").try_cast("double")), "margins")
    # ranks: how many are below, over all criteria and sides in order, less what is before the first of each
    below = kept(scanned(margins, [F.col("criterion"), F.col("side"), F.col("value"), F.col("v")], {"before": F.col("n")}, "below"), "ranks")
    first = below.groupBy("criterion", "side").agg(F.min("before").alias("first"))
    ranks = below.join(first, ["criterion", "side"]).select("criterion", "side", "v", (F.col("before") - F.col("first") + (F.col("n") + 1) / 2).alias("r"))
    rank = lambda side: ranks.where(F.col("side") == side).select("criterion", F.col("v").alias(side), F.col("r").alias(f"r{side}"))
    both = margins.groupBy("criterion", "v").agg(*(F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).cast("double").alias(f"n{s}") for s in "xy"))
    sums = both.groupBy("criterion").agg(F.sum(F.col("nx") * F.col("ny")).alias("chance"), F.sum(F.pow(F.col("nx") + F.col("ny"), 2)).alias("sq"))
    numbers = F.sum(F.when(F.col("x").try_cast("double").isNotNull() & F.col("y").try_cast("double").isNotNull(), F.col("n")).otherwise(0)).alias("numbers")
    weigh = lambda e, name: F.sum(F.col("n") * e).alias(name)
    rx, ry = F.col("rx"), F.col("ry")
    total = table.join(rank("x"), ["criterion", "x"]).join(rank("y"), ["criterion", "y"]).groupBy("criterion").agg(
        F.sum("n").alias("pairs"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0)).cast("double").alias("same"), numbers,
        weigh(rx, "sx"), weigh(ry, "sy"), weigh(rx * rx, "xx"), weigh(ry * ry, "yy"), weigh(rx * ry, "xy"),
    )
    t = F.col("pairs").cast("double")
    chance, n = F.col("chance") / (t * t), 2 * t
    kappa = F.try_divide(F.col("same") / t - chance, 1 - chance)
    alpha = 1 - F.try_divide((n - 1) * 2 * (t - F.col("same")), n * n - F.col("sq"))
    spread = (t * F.col("xx") - F.pow("sx", F.lit(2))) * (t * F.col("yy") - F.pow("sy", F.lit(2)))
    rho = F.when(F.col("numbers") == F.col("pairs"), F.try_divide(t * F.col("xy") - F.col("sx") * F.col("sy"), F.sqrt(spread)))
    several = lambda e: F.when(F.col("pairs") >= 2, e)
    return total.join(sums, "criterion").select(
        "criterion", "pairs", several(kappa).alias("cohen_kappa"), several(alpha).alias("krippendorff_alpha"), several(rho).alias("spearman")
    )


def agreement(df: DataFrame, criteria: list[str]) -> DataFrame:
    """One row: accuracy, its baseline, and the means over criteria (0 if none can be had) of kappa, alpha and Spearman."""
    pairs = [(f"agent_{c}", c) for c in criteria]
    means = by_criterion(df, criteria).agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(o) for c, o in (
        ("cohen_kappa", "cohen_kappa"), ("krippendorff_alpha", "krippendorff_alpha"), ("spearman", "spearman_correlation"))])
    return mean_accuracy(df, pairs).join(F.broadcast(means))


def split(df: DataFrame, column: str, share: float, order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by whole groups, ``clamp(int(n * share), 1, n - 1)`` groups to train; null groups test.

    The order's value at the cut comes from counts over buckets of it, so no task sorts all groups.
    """
    order = order if order is not None else F.xxhash64(F.lit(42384), column)
    groups = df.where(F.col(column).isNotNull()).select(column).distinct().withColumn("_order", order.cast("long"))
    n = groups.count()
    if n < 2:
        raise ValueError("a split needs two groups")
    left = min(max(int(n * share), 1), n - 1)
    bucket = range_bucket(groups, "_order")
    sizes = {r["b"]: r["n"] for r in groups.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}
    at = min(sizes)
    while left > sizes.get(at, 0):
        left -= sizes.get(at, 0)
        at += 1
    last = groups.where(bucket == at).orderBy("_order", column).limit(left).select(column)
    taken = groups.where(bucket < at).select(column).unionByName(last)
    return df.join(taken, column, "left_semi"), df.join(taken, column, "left_anti")
