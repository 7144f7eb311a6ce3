"""Placement by a permutation-filled lookup table.

Every shard has a permutation of the slots of a prime-sized table (an offset and
a stride from hashes of its name).  Shards take turns; on its turn a shard claims
the next free slot in its order, as often as its weight says.  A key is placed by
one look at slot ``hash(key) mod size``: the table is broadcast, its size bounded
by ``MOST_SLOTS`` whatever the data.  When a shard comes or goes few keys move.

The table is filled on the driver (it depends on shard names alone); placing rows
uses DataFrame functions only and does not shuffle.

Defined cases: a null key is placed as the empty string; equal keys share a
shard; repeated rows each get one.  Extra columns of any name are carried through, but
for ``slot`` and ``shard``, which are replaced (one of them may be the key).  An empty
table gives an empty one.  A very long key is hashed whole.  Shards of one turn claim
in the order given, so no slot is tied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text

MOST_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], size: int, weights: Sequence[int] | None = None) -> list[int]:
    """The shard number of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be there and differ")
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    weights = list(weights or [1] * len(shards))
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("each shard needs a weight of at least 1")
    at = [_number(s, "offset") % size for s in shards]
    stride = [_number(s, "stride") % (size - 1) + 1 if size > 1 else 1 for s in shards]
    table = [-1] * size
    left = size
    while left:
        for k in range(len(shards)):
            for _ in range(min(weights[k], left)):
                while table[at[k]] >= 0:
                    at[k] = (at[k] + stride[k]) % size
                table[at[k]] = k
                left -= 1
    return table


def slot_of(key: Column, size: int) -> Column:
    """A slot by the first 60 bits of the key's MD5."""
    return F.pmod(F.conv(F.substring(F.md5(as_text(key.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size))


def lookup(spark: SparkSession, shards: Sequence[str], size: int, weights: Sequence[int] | None = None) -> DataFrame:
    """The filled table as rows ``slot, shard``."""
    numbers = ",".join(map(str, fill(shards, size, weights)))
    of = spark.range(1).select(F.posexplode(F.split(F.lit(numbers), ",")).alias("slot", "n"))
    names = F.array(*map(F.lit, shards))
    return of.select(F.col("slot").cast("long").alias("slot"), F.element_at(names, F.col("n").cast("int") + 1).alias("shard"))


def place(df: DataFrame, key: str, shards: Sequence[str], size: int = 65537, weights: Sequence[int] | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` to each row."""
    names = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    slot = slot_of(df[f"`{key}`"], size).alias("slot")
    row = [F.struct(*[df[f"`{c}`"] for c in names]).alias("row")] if names else []
    placed = df.select(*row, slot).join(F.broadcast(lookup(df.sparkSession, shards, size, weights)), "slot")
    return placed.select(*(["row.*"] if names else []), "slot", "shard")
