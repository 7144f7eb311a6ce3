"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. One pass over the texts gives each document its set size, a 128-bit digest of
   the set, the low bits of its minima (packed) and one key for each band.
   Documents with equal sets are a class; only its smallest id goes on.
2. Members of a band bucket are compared with the bucket's smallest id: packed
   signatures first (collision-corrected estimate), full sets after that.  A
   group of near copies is joined up here without any pairs among its members.
3. Buckets whose members are still in more than one component are compared in
   cells of two blocks, pairs of one component left out.  Members with a pair that
   the estimate lets through get their full sets, and the cell puts out links
   between components, never its pairs.

With 32 bands of 4 rows a pair at similarity 0.8 shares no bucket with
probability 5e-8 and one at 0.85 with 6e-11.  The estimate's margin is six
standard deviations.  No bucket is capped.

Defined cases: a null or blank text has an empty set and links with nothing.
Repeated rows all get the same answer.  Ties do not arise: of a group the smallest id
stays.  A very long text is hashed in pieces; its memory is 8 bytes a word.  Rows with a null id take the component
of an equal set that has an id, else null; they are kept only in that last case.
Extra columns are ignored here and carried through by :func:`drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.graph import components
from assayworks.llm.shared import forget, reading, release, tidy, written
from assayworks.llm.shingles import Signer, estimate, matches, mix, shingle_sets


@dataclass(frozen=True)
class Settings:
    width: int = 5
    #: A link: ``per * intersection >= least * union``.
    least: int = 80
    per: int = 100
    bands: int = 32
    rows: int = 4
    bits: int = 4
    #: Members and shingles of a block in step 3.
    block: int = 1024
    block_shingles: int = 1_000_000
    #: So many ids (8 bytes each) may be broadcast to pick the texts to confirm.
    broadcast_ids: int = 500_000

    @property
    def least_estimate(self) -> float:
        """Estimates below this are six standard deviations under the threshold."""
        chance, k = 0.5**self.bits, self.bands * self.rows
        p = self.least / self.per * (1 - chance) + chance
        return self.least / self.per - 6 * (p * (1 - p) / k) ** 0.5 / (1 - chance)


_PRINT = "doc_id long, n_shingles long, high long, low long, sig binary, bands array<long>"


def _print_schema() -> pa.Schema:
    return pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("high", pa.int64()),
            ("low", pa.int64()),
            ("sig", pa.binary()),
            ("bands", pa.list_(pa.int64())),
        ]
    )


def fingerprints(docs: DataFrame, s: Settings) -> DataFrame:
    """Set size, set digest, packed signature and band keys of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, schema = Signer(s.bands, s.rows, s.bits), _print_schema()
        for batch in batches:
            ids = batch.column(0)
            for first, sets in shingle_sets(batch.column(1), s.width):
                sizes = np.array([len(x) for x in sets], np.int64)
                full = np.flatnonzero(sizes)
                high, low = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                sig: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if len(full):
                    some = [sets[i] for i in full]
                    minima = signer.minima(some)
                    at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    flat = np.concatenate(some)
                    high[full] = np.add.reduceat(mix(flat), at).view(np.int64)
                    low[full] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), at).view(np.int64)
                    packed, bands = signer.packed(minima), signer.band_keys(minima)
                    for j, i in enumerate(full):
                        sig[i], keys[i] = packed[j].tobytes(), bands[j]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sets)).cast(pa.int64()),
                        pa.array(sizes),
                        pa.array(high),
                        pa.array(low),
                        pa.array(sig, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )
        tidy()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PRINT)


def _estimated(pairs: DataFrame, s: Settings) -> DataFrame:
    """Keep pairs ``(a, b, sig_a, sig_b)`` whose estimate reaches the margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_words(batch.column(c)) for c in ("sig_a", "sig_b"))
            near = estimate(matches(x, y, s.bits), s.bands * s.rows, s.bits) >= s.least_estimate
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Keep pairs ``(a, b)`` whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, at, which = np.unique(batch.column("a").to_numpy(), return_index=True, return_inverse=True)
            mine: list[np.ndarray] = []
            for _, sets in shingle_sets(batch.column("text_a").take(pa.array(at)), s.width):
                mine.extend(sets)
            ok = np.zeros(batch.num_rows, bool)
            for first, sets in shingle_sets(batch.column("text_b"), s.width):
                for i, y in enumerate(sets, first):
                    x = mine[which[i]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i] = both > 0 and s.per * both >= s.least * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
        tidy()

    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _texts_of(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """Texts of the documents ``ids(id)``, one row an id.

    Up to ``broadcast_ids`` ids go to the scan as a hash set, so only their texts
    are shuffled; more are joined by a shuffle of all.
    """
    ids = written(ids.select(F.col("id").alias("doc_id")).distinct(), "ids")
    few = ids.count() <= s.broadcast_ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").withColumnRenamed("doc_id", "id")
    out = written(found.dropDuplicates(["id"]), "texts")
    forget(ids)
    return out


def _cells(buckets: DataFrame, s: Settings) -> DataFrame:
    """Deal the members of ``buckets(band, key, id, comp, n, sig, bands)`` into cells of two blocks.

    A bucket's most frequent component is dealt into blocks that meet only the
    blocks of the other members; those meet each other.  Blocks are bounded in
    members and in shingles.
    """
    by_comp = buckets.groupBy("key", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    # a plain table: the join with a bucket of very many members is then split by AQE
    of = by_comp.groupBy("key").agg(
        F.max_by("comp", F.struct("m", "comp")).alias("main"),
        F.max(F.struct("m", "comp", "n")).alias("top"),
        F.sum("m").alias("m"),
        F.sum("n").alias("n"),
    )

    def blocks(members, shingles):
        return F.ceil(F.greatest(members / s.block, shingles / s.block_shingles)).cast("int")

    of = written(
        of.select(
            "key",
            "main",
            blocks(F.col("top.m"), F.col("top.n")).alias("k_main"),
            blocks(F.col("m") - F.col("top.m"), F.col("n") - F.col("top.n")).alias("k_rest"),
        ),
        "blocks",
    )
    placed = buckets.join(of, "key").withColumn("is_main", F.col("comp") == F.col("main"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("k_main")).otherwise(F.col("k_rest"))).cast("int")
    # cells (x, y): x is a block of the rest; y >= 0 a block of the rest, not before x; y < 0 a block of the main component
    rest = F.sequence(F.lit(0), F.col("k_rest") - 1)
    as_main = F.transform(rest, lambda x: F.struct(x.alias("x"), (-1 - F.col("own")).alias("y")))
    as_rest = F.concat(
        F.transform(rest, lambda x: F.struct(F.least(x, F.col("own")).alias("x"), F.greatest(x, F.col("own")).alias("y"))),
        F.transform(F.sequence(F.lit(1), F.col("k_main")), lambda y: F.struct(F.col("own").alias("x"), (-y).alias("y"))),
    )
    out = (
        placed.withColumn("own", own)
        .withColumn("cell", F.explode(F.when(F.col("is_main"), as_main).otherwise(as_rest)))
        .select("key", "cell.x", "cell.y", "own", "is_main", "id", "comp", "sig", "bands")
    )
    return reading(_spread(out), of)


def _spread(cells: DataFrame) -> DataFrame:
    """Deal rows by whole cells; by their bucket alone a bucket's cells would all be one task's."""
    return cells.repartition(*_CELL)


def _cell_pairs(cell: pa.Table, s: Settings):
    """Yield ``(i, js)``: rows of a cell worth comparing, of two components, first met in this band."""
    ids, comp, own, is_main = (cell.column(c).to_numpy() for c in ("id", "comp", "own", "is_main"))
    key, x, y = (cell.column(c)[0].as_py() for c in _CELL)
    left = np.flatnonzero(~is_main & (own == x))
    right = np.flatnonzero(is_main) if y < 0 else np.flatnonzero(~is_main & (own == y))
    if not len(left) or not len(right):
        return
    sig = _words(cell.column("sig").combine_chunks())
    keys = cell.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    band = int(np.flatnonzero(keys[0] == key)[0])
    for i in left:
        js = right[comp[right] != comp[i]]
        if y == x:
            js = js[ids[js] > ids[i]]
        if len(js) and band:
            js = js[~(keys[i, :band] == keys[js, :band]).any(axis=1)]
        if len(js):
            js = js[estimate(matches(sig[i], sig[js], s.bits), s.bands * s.rows, s.bits) >= s.least_estimate]
        if len(js):
            yield i, js


_CELL = ["key", "x", "y"]


def _hopeful(cells: DataFrame, s: Settings) -> DataFrame:
    """The members of each cell that have a pair worth comparing there."""

    def run(cell: pa.Table) -> pa.Table:
        hit = np.zeros(cell.num_rows, bool)
        for i, js in _cell_pairs(cell, s):
            hit[i] = True
            hit[js] = True
        return cell.filter(pa.array(hit))

    return cells.groupBy(*_CELL).applyInArrow(run, cells.schema)


def _cross_links(cells: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Links ``(a, b)`` between components that a pair of full sets in one cell joins."""

    def run(cell: pa.Table) -> pa.Table:
        comp = cell.column("comp").to_numpy()
        sets: list[np.ndarray] = []
        for _, some in shingle_sets(cell.column("text"), s.width):
            sets.extend(some)
        sizes = np.array([len(x) for x in sets])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(names), np.int64)
        found = set()
        for i, js in _cell_pairs(cell, s):
            mine = flat[begins[i] : ends[i]]
            mark[mine] = 1
            took = np.concatenate([flat[begins[j] : ends[j]] for j in js])
            both = np.add.reduceat(mark[took], np.cumsum(sizes[js]) - sizes[js])
            mark[mine] = 0
            ok = s.per * both >= s.least * (sizes[i] + sizes[js] - both)
            found.update((comp[i], c) for c in np.unique(comp[js[ok]]))
        return pa.table({"a": pa.array([int(a) for a, _ in found], pa.int64()), "b": pa.array([int(b) for _, b in found], pa.int64())})

    return _spread(cells.join(texts, "id")).groupBy(*_CELL).applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs(doc_id, text)`` to ``doc_id, n_shingles, component_id, kept``, a row for each input row."""
    s = settings or Settings()
    docs = docs.select("doc_id", "text")
    prints = written(fingerprints(docs, s), "prints")
    keys = ["high", "low", "n_shingles"]
    full = prints.where("n_shingles > 0 and doc_id is not null")
    reps = written(
        full.groupBy(*keys).agg(F.min(F.struct("doc_id", "sig", "bands")).alias("rep"))
        .select(*keys, F.col("rep.doc_id").alias("id"), F.col("n_shingles").alias("n"), "rep.sig", "rep.bands"),
        "reps",
    )
    # a band's number is part of its key's hash
    banded = reps.select("id", F.explode("bands").alias("key"))
    leaders = written(banded.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").drop("z"), "leaders")
    crowded = written(banded.join(leaders, "key").select("key", "id", "a"), "buckets")
    stars = crowded.where("a <> id").select("a", F.col("id").alias("b")).distinct()
    with_sig = (
        stars.join(reps.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .join(reps.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    )
    tried = written(_estimated(with_sig, s), "pairs", few=False)
    texts = _texts_of(docs, tried.select(F.explode(F.array("a", "b")).alias("id")), s)
    links = written(_confirmed(tried, texts, s), "links", few=False)
    forget(texts, tried, leaders)
    hung = components(links)
    rest = written(_open_buckets(crowded, hung).join(reps, "id").select("key", "id", "comp", "n", "sig", "bands"), "open")
    every = _cells(rest, s)
    cells = written(_hopeful(every, s), "cells", few=False)
    release(every)
    forget(rest, crowded)
    if cells.head(1):
        texts = _texts_of(docs, cells.select("id"), s)
        found = written(_cross_links(cells, texts, s), "links", few=False)
        forget(texts)
        if found.head(1):
            release(hung)
            hung = components(links.unionByName(found))
        forget(found)
    forget(cells, links)
    of_class = written(reps.join(hung, "id", "left").select(*keys, F.coalesce("component", "id").alias("component")), "classes")
    release(hung)
    forget(reps)
    # both sides are plain tables: a set of very many rows is a skewed join that AQE splits
    out = prints.select("doc_id", *keys).join(of_class, keys, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
    return reading(out, prints, of_class)


def _open_buckets(crowded: DataFrame, hung: DataFrame) -> DataFrame:
    """Members ``(key, id, comp)`` of buckets that hold more than one component."""
    member = crowded.join(hung, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    # of two members one is the bucket's smallest id, so step 2 has compared them
    seen = F.count("*").alias("m")
    several = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), seen).where("lo <> hi and m > 2")
    return member.join(several.select("key"), "key")


def drop_near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id, once.

    Columns stay as they are.  Rows that repeat an id stay once.  Rows without an
    id cannot be told apart and all stay.  Up to ``broadcast_ids`` ids to remove go
    to the scan as a hash set; more are joined by a shuffle.
    """
    s = settings or Settings()
    result = near_duplicates(docs, s)
    found = written(result.where("doc_id is not null"), "found")
    release(result)
    gone = written(found.where("not kept").select(F.col("doc_id").alias("id")).distinct(), "gone")
    twice = written(found.where("kept").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id"), "twice")
    forget(found)
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("id"))

    def bounded(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= s.broadcast_ids else ids

    kept = keyed.join(bounded(gone), "id", "left_anti")
    if twice.head(1):
        ids = bounded(twice)
        once = kept.join(ids, "id", "left_semi").dropDuplicates(["id"])
        kept = kept.join(ids, "id", "left_anti").unionByName(once)
    return reading(kept.select("row.*"), gone, twice)
