"""Benchmark decontamination: windows of benchmark words looked up in every document.

The hashes of the benchmark's windows (ten words, or a whole shorter item) are a
bitmap that goes to every task with the plan: 32 bits a window, at most 4 MB
whatever the benchmark.  Each document hashes its own windows within its row, and only
those whose bit is set (all hits, and one in 32 others or more beyond four million
windows) are joined with the windows and verified word by word.  Texts are not
shuffled: rows are written once with what the bitmap lets through.  There is one plan for any
size.  DataFrame and SQL functions only.

Words are runs of digits, letters a to z (A to Z lower-cased) and non-ASCII
characters.  A document word inside any occurrence of a window is hit.

Defined cases: null and wordless texts have no words and no hits; null and
wordless items have no windows; an item without an id still hits, but isn't
listed.  Ids may be of any type.  An empty benchmark hits nothing.  Repeated documents
each get a row; repeated items count once.  Extra columns of the documents of any name
are ignored or carried through.  A very long text takes memory in proportion to its
words.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text, forget, reading, written

WINDOW = 10
#: Java regular expression of what parts words, in a text whose A-Z are lower-cased, or not.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the fast way where the text is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.filter(F.split(ascii_lower(as_text(text)), _GAP), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows ``h, n, w, items``: hash, words, joined words, ids of the items that hold it."""
    parted = benchmark.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    n = F.least(F.size("ws"), F.lit(width))
    at = F.explode(F.sequence(F.lit(1), F.size("ws") - n + 1))
    each = parted.select("item_id", n.alias("n"), "ws", at.alias("i")).select("item_id", "n", F.slice("ws", F.col("i"), F.col("n")).alias("ws"))
    hashed = each.select("item_id", "n", F.xxhash64("ws").alias("h"), F.array_join("ws", " ").alias("w"))
    return hashed.groupBy("h", "n", "w").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _starts(n: Column, ws: Column, lengths: list[int]) -> Column:
    """Structs ``n, i, h`` of all windows of the given lengths."""

    def of_length(k: int) -> Column:
        begins = F.when(n >= k, F.sequence(F.lit(1), n - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(begins, lambda i: F.struct(F.lit(k).alias("n"), i.alias("i"), F.xxhash64(F.slice(ws, i, F.lit(k))).alias("h")))

    return F.flatten(F.array(*map(of_length, lengths)))


#: Longs of the bitmap: at most 4 MB.
MOST_LONGS = 1 << 19


def _bitmap(windows: DataFrame, longs: int) -> Column:
    """The windows' hashes as a literal array of so many longs, a power of two."""
    at, bit = _bit(F.col("h"), longs)
    rows = windows.groupBy(at.alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")).collect()
    out = [0] * longs
    for r in rows:
        out[r["at"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(out)), "array<bigint>")


def _bit(h: Column, longs: int) -> tuple[Column, Column]:
    """The long and the bit of a hash."""
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(longs - 1)).cast("int"), h.bitwiseAND(F.lit(63)).cast("int")


def _looked_up(docs: DataFrame, carried: list[str], benchmark: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Each row ``id, row, n_words, maybe`` (windows the bitmap lets through), and ``id, places, items`` of rows with hits."""
    windows = written(benchmark_windows(benchmark, width), "windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most width of them
    row = F.struct(*[docs[f"`{c}`"] for c in carried]).alias("row")
    rows = docs.select(row, words(F.col("text")).alias("ws")).withColumn("n_words", F.size("ws"))
    if lengths:
        longs = min(MOST_LONGS, 1 << max(4, (max(1, windows.count()) // 2).bit_length()))
        bits = _bitmap(windows, longs)

        def may(x: Column) -> Column:
            at, bit = _bit(x.h, longs)
            return F.call_function("shiftrightunsigned", F.get(bits, at), bit).bitwiseAND(F.lit(1)) == 1

        rows = rows.withColumn("starts", _starts(F.col("n_words"), F.col("ws"), lengths))
        rows = rows.withColumn("starts", F.filter("starts", may))
        maybe = F.transform("starts", lambda x: F.struct(x.i.alias("i"), x.n.alias("n"), x.h.alias("h"), F.array_join(F.slice("ws", x.i, x.n), " ").alias("w")))
    else:
        maybe = F.array().cast("array<struct<i:int,n:int,h:bigint,w:string>>")
    scan = written(rows.select(F.monotonically_increasing_id().alias("id"), "row", "n_words", maybe.alias("maybe")), "scanned")
    each = scan.where(F.size("maybe") > 0).select("id", F.explode("maybe").alias("x")).select("id", "x.i", "x.n", "x.h", "x.w")
    met = each.join(windows, ["h", "n", "w"]).groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence("i", F.col("i") + F.col("n") - 1)))).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    hits = written(met, "hits")
    forget(windows)
    return scan, hits


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, items, contaminated`` of each document."""
    scan, hits = _looked_up(docs, ["doc_id"], benchmark, width)
    found = scan.drop("maybe").join(hits, "id", "left")
    n_hit = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast(hits.schema["items"].dataType))
    names = F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",")
    out = found.select(
        "row.doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.when(F.col("places").isNull(), F.lit(0)).otherwise(n_hit).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        items.alias("items"),
        F.col("places").isNotNull().alias("contaminated"),
    )
    return reading(out, scan, hits)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WINDOW) -> DataFrame:
    """The documents without contamination, columns as they are.

    ``remove="documents"`` leaves out every document that holds a window;
    ``"spans"`` keeps them without the words that are hit, unless none is left.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    scan, hits = _looked_up(docs, docs.columns, benchmark, width)
    clean = scan.where(F.size("maybe") == 0).select("row")
    told = scan.where(F.size("maybe") > 0).join(hits, "id", "left")  # few rows
    clean = clean.unionByName(told.where(F.col("places").isNull()).select("row"))
    if remove == "documents":
        return reading(clean.select("row.*"), scan, hits)
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    hit = told.where(F.col("places").isNotNull() & (F.size("places") < F.col("n_words")))
    hit = hit.select("row", "places", F.regexp_extract_all("row.text", F.lit(word), F.lit(0)).alias("own"), F.split("row.text", word, -1).alias("gaps"))
    kept = F.transform("own", lambda w, i: F.concat(F.get("gaps", i), F.when(F.array_contains("places", i + 1), "").otherwise(w)))
    text = F.concat(F.array_join(kept, ""), F.element_at("gaps", -1))
    cut = hit.select(F.col("row").withField("text", text).alias("row"))
    return reading(clean.unionByName(cut).select("row.*"), scan, hits)
