"""Peak concurrency: how much is open at each moment, and the highest it has been.

Method: SQL windows on two levels.  Starts and ends are netted for each key and
moment before anything else, which leaves a key at most a row a minute however many
spans it has.  Within a key's day running sums give what the day adds; the days'
subtotals are scanned into carries, the days' maxima likewise into highs, and their
first moments into the moment after a day's last; carries, highs and next moments are
joined back to the days' rows.  A task gets whole days of keys, at most 1,440
rows each; the scan of days gets a row a key and day.  Nothing that grows with the
number of spans passes one task, the driver or a broadcast.

Defined cases: a span without a start, or whose stop isn't after it, takes no part; one
without a stop stays open.  A null key is one key, a null amount 0.  Repeated rows are spans
each.  Moments whose starts and ends together change neither count nor amount give no row.
An empty table gives an empty one.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import reading, written

#: Seconds of a moment, of a bucket, and after the last dispatch of a sale.
MINUTE, DAY, RETURNS = 60, 86_400, 7 * 86_400
UNKNOWN, ALL = -1, -2

_SWEEP = """
with net as (
  select key, at, sum(n) as n, sum(amount) as amount
  from (select key, inline(array(struct(start_s as at, 1L as n, amount as amount), struct(stop_s as at, -1L as n, -amount as amount)))
        from {spans} where start_s is not null and (stop_s is null or stop_s > start_s))
  where at is not null group by key, at),
whole as (
  select key, at, sum(n) as n, sum(amount) as amount
  from (select key, at, n, amount from net union all select {total} as key, at, n, amount from net where {total} is not null)
  group by key, at having sum(n) <> 0 or sum(amount) <> 0),
days as (
  select key, at - pmod(at, {day}) as day, at, n, amount from whole),
running as (
  select key, day, at, n, amount, sum(n) over w as n_run, sum(amount) over w as amount_run, lead(at) over w1 as next_at
  from days
  window w as (partition by key, day order by at rows unbounded preceding), w1 as (partition by key, day order by at)),
highs as (
  select *, max(n_run) over (partition by key, day order by at rows unbounded preceding) as high_run from running),
buckets as (
  select key, day, sum(n) as n, sum(amount) as amount, max(n_run) as high, min(at) as first_at from running group by key, day),
carried as (
  select key, day, first_at, high,
    coalesce(sum(n) over before, 0L) as n0, coalesce(sum(amount) over before, 0L) as amount0, lead(first_at) over (partition by key order by day) as next_day_at
  from buckets window before as (partition by key order by day rows between unbounded preceding and 1 preceding)),
carries as (
  select key, day, n0, amount0, next_day_at,
    max(n0 + high) over (partition by key order by day rows between unbounded preceding and 1 preceding) as high0,
    max(n0 + high) over (partition by key) as peak
  from carried)
select h.key, h.at as from_s, coalesce(h.next_at, c.next_day_at) as to_s, c.n0 + h.n_run as n_open, c.amount0 + h.amount_run as open_amount,
  greatest(c.n0 + h.high_run, c.high0) as high_open, c.n0 + h.n_run = c.peak as is_peak
from highs h join carries c on h.key <=> c.key and h.day = c.day
"""


def sweep(spans: DataFrame, total: int | None = None) -> DataFrame:
    """``key, from_s, to_s, n_open, open_amount, high_open, is_peak`` of ``spans(key, start_s, stop_s, amount)`` in seconds.

    With ``total`` each span counts again for the key of that name.
    """
    told = spans.select("key", *(F.col(c).cast("long").alias(c) for c in ("start_s", "stop_s")), F.coalesce(F.col("amount").cast("long"), F.lit(0)).alias("amount"))
    kind = spans.schema["key"].dataType.simpleString()
    every = f"cast({'null' if total is None else int(total)} as {kind})"
    return spans.sparkSession.sql(_SWEEP.replace("{total}", every), spans=told, day=DAY)


def seconds(ts: Column) -> Column:
    """A time without a zone as UTC seconds, rounded down to whole minutes."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts.cast("timestamp_ntz"))
    return ((micros - F.pmod(micros, F.lit(MINUTE * 1_000_000))) / 1_000_000).cast("long")


def cents(total: Column) -> Column:
    """Money in whole cents, half up; null, what is no number, and what no long holds is 0."""
    return F.when(F.abs(total) < 1e15, F.floor(100 * total + F.lit(0.5))).otherwise(0).cast("long")


def open_sales(sales: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """A span for each sale: from ``sold_at`` until a week after its last dispatch, under its client's nation.

    A sale without a dispatched line stays open.  Sales of no known client or nation have the key -1; of a
    client's repeated rows the smallest nation counts.  Both tables are reduced to a row a key and written, so that
    the joins are plain and AQE splits the partition of a client or sale with very many rows.
    """
    last = lines.where("sale_id is not null and shipped_at is not null").groupBy("sale_id").agg((seconds(F.max("shipped_at")) + RETURNS).alias("stop_s"))
    homes = clients.where("client_id is not null and nation_id is not null").groupBy("client_id").agg(F.min("nation_id").cast("int").alias("nation"))
    last, homes = written(last, "dispatches"), written(homes, "homes")
    sold = sales.where("sold_at is not null").select("sale_id", "client_id", seconds(F.col("sold_at")).alias("start_s"), cents(F.col("total")).alias("amount"))
    ended = sold.join(last, "sale_id", "left").where("stop_s is null or stop_s > start_s").select("client_id", "start_s", "stop_s", "amount")
    placed = ended.join(homes, "client_id", "left").select(F.coalesce("nation", F.lit(UNKNOWN)).alias("key"), "start_s", "stop_s", "amount")
    return reading(placed, last, homes)
