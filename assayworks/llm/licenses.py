"""License notices in whole texts, by MinHash bands over overlapping windows.

1. Words give five-word shingles, hashed to 64 bits.
2. Templates are put in classes by their number of distinct shingles: class ``c`` takes up
   to ``64 * 2**c``.  Its windows are five blocks of ``16 * 2**c`` shingles, a block apart, so
   whatever is as long as a template lies whole in a window.
3. A window's bands are minima of its hashes under ``bands`` permutations (xor with a
   constant, and its complement, which is the maximum), one row a band; those of larger
   blocks come from those of smaller ones.  A template that shares a band is
   retrieved.  Templates of class 0 hold as little as one shingle; their windows' bands
   are those of each single shingle in them, which is the minimum of itself.
4. The share of the retrieved template's distinct shingles that the window holds,
   counted exactly, must reach ``least``.

Above class 0 a template has at least half of its class's shingles.  An exact copy then has a
Jaccard similarity of at least 0.4 with its window and is missed by 16 bands with a
probability of at most 0.6**16 = 3e-4 (3e-12 for a template that fills its class); a
copy at a share of 0.8 with at most 0.7**16 = 4e-3.  In class 0 nothing is missed.

The bands of all templates are a bitmap that goes with the plan, four thousand bits a band, at most
4 MB; only windows with a band in it leave the row and are joined with the templates.  The plan
doesn't grow with the list, texts are not shuffled.  DataFrame functions only.

Defined cases: null and wordless texts, and those of fewer than five words, hold
no license.  Repeated rows each get an answer.  A template that occurs several
times in a text is listed once, by the first of its best windows.  Extra columns are
ignored.  An empty table gives an empty one.  A very long text takes about 200 bytes a word.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.decontamination import words
from assayworks.llm.shared import forget, reading, written

#: Notices and texts of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "you may not use this file except in compliance with the License",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR "
        "A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
        "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT": "Released under the MIT License",
    "MIT-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
WIDTH = 5
#: Shingles of a block of class 0, blocks of a window, blocks that a class's templates fill at most.
BLOCK, SPAN, FILL = 16, 5, 4
MOST_LONGS = 1 << 19
#: Four thousand bits a band.
_BITS = 4096


def block_of(c: int) -> int:
    return BLOCK << c


def class_of(n_shingles: int) -> int:
    c = 0
    while FILL * block_of(c) < n_shingles:
        c += 1
    return c


def _constant(k: int) -> int:
    """The constant of a permutation: the top bits differ, so each picks among other hashes."""
    x = (k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return x - (1 << 64) if x >> 63 else x


def _shingles(ws: Column) -> Column:
    n = F.size(ws)
    begins = F.when(n >= WIDTH, F.sequence(F.lit(1), n - (WIDTH - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(begins, lambda i: F.xxhash64(F.slice(ws, i, F.lit(WIDTH))))


def _let(value: Column, then) -> Column:
    """An expression of a value that is worked out once, not wherever it is used."""
    return F.transform(F.array(value), then)[0]


def _bands(sh: Column, bands: int) -> Column:
    """The bands of a set of shingles: minima and maxima under each constant in turn."""

    def ends(k: int) -> Column:
        return _let(F.transform(sh, lambda h: h.bitwiseXOR(F.lit(_constant(k)))), lambda p: F.array(F.array_min(p), F.array_max(p)))

    return F.flatten(F.array(*map(ends, range(bands // 2))))


def _together(parts: Column, bands: int) -> Column:
    """The bands of the union of sets, from theirs."""

    def of(j: int) -> Column:
        return (F.array_max if j % 2 else F.array_min)(F.transform(parts, lambda b: b[j]))

    return F.array(*map(of, range(bands)))


def _every(n: Column, step: int) -> Column:
    """1, 1 + step and so on up to n; none of no elements."""
    return F.when(n > 0, F.sequence(F.lit(1), n, F.lit(step))).otherwise(F.array().cast("array<int>"))


def compiled(spark, templates: Mapping[str, str], bands: int) -> tuple[DataFrame, DataFrame]:
    """``license, c, n, t`` (class, number and array of shingles) and ``c, j, v, license`` (bands), written tables."""
    df = spark.createDataFrame(sorted(templates.items()), "license string, text string").select("license", words(F.col("text")).alias("ws"))
    df = df.select("license", F.array_distinct(_shingles(F.col("ws"))).alias("t")).withColumn("n", F.size("t"))
    c = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (FILL * BLOCK))).cast("int"))
    known = written(df.select("license", c.alias("c"), "n", "t"), "templates")
    short = [r["license"] for r in known.where("n = 0").select("license").collect()]
    if short:
        forget(known)
        raise ValueError(f"templates of fewer than {WIDTH} words: {short}")
    of = F.when(F.col("c") == 0, F.transform("t", lambda h: F.struct(F.lit(0).alias("j"), h.alias("v")))).otherwise(
        F.transform(_bands(F.col("t"), bands), lambda v, j: F.struct(j.alias("j"), v.alias("v")))
    )
    keys = written(known.select("license", "c", F.explode(of).alias("x")).select("c", "x.j", "x.v", "license"), "bands")
    return known, keys


def _place(v: Column, longs: int) -> tuple[Column, Column]:
    """The long and the bit of a band in the bitmap, by its low bits: being a minimum shows in the high ones."""
    return F.shiftrightunsigned(v, 6).bitwiseAND(F.lit(longs - 1)).cast("int"), v.bitwiseAND(F.lit(63)).cast("int")


def _bitmap(keys: DataFrame, longs: int) -> Column:
    """All bands as a literal array of longs, a power of two of them."""
    at, bit = _place(F.col("v"), longs)
    bits = [0] * longs
    for r in keys.groupBy(at.alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")).collect():
        bits[r["at"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(bits)), "array<bigint>")


def _candidate(c: int, w: Column, keys: Column) -> Column:
    step = block_of(c)
    held = F.array_distinct(F.slice("sh", w * step + 1, F.lit(SPAN * step)))
    return F.struct(F.lit(c).alias("c"), w.alias("w"), held.alias("held"), keys.alias("keys"))


def _candidates(rows: DataFrame, classes: list[int], bands: int, shelf: Column, longs: int) -> DataFrame:
    """Turn ``sh`` into ``found``: the windows with a band in the bitmap, their shingles and bands.

    The bands of a window of class 0 are its shingles; they aren't written twice.
    """

    def may(v: Column) -> Column:
        at, bit = _place(v, longs)
        return F.call_function("shiftrightunsigned", F.get(shelf, at), bit).bitwiseAND(F.lit(1)) == 1

    made = []
    if classes[0] == 0:
        hit = F.filter(F.transform("sh", lambda h, i: F.when(may(h), i)), lambda i: i.isNotNull())
        rows = rows.withColumn("hit", hit)
        last = lambda i: F.floor(i / BLOCK).cast("int")
        near = F.array_distinct(F.flatten(F.transform("hit", lambda i: F.sequence(F.greatest(last(i) - (SPAN - 1), F.lit(0)), last(i)))))
        rows = rows.withColumn("f0", F.transform(near, lambda w: _candidate(0, w, F.array().cast("array<bigint>")))).drop("hit")
        made.append("f0")
    if classes[-1]:
        step = block_of(1)
        blocks = F.transform(_every(F.size("sh"), step), lambda a: _let(F.slice("sh", a, F.lit(step)), lambda sub: _bands(sub, bands)))
        rows = rows.withColumn("b", blocks)
        for c in range(1, classes[-1] + 1):
            if c > 1:
                rows = rows.withColumn("b", F.transform(_every(F.size("b"), 2), lambda a: _let(F.slice("b", a, F.lit(2)), lambda p: _together(p, bands))))
            if c not in classes:
                continue
            rows = rows.withColumn("w", F.transform(_every(F.size("b"), 1), lambda a: _let(F.slice("b", a, F.lit(SPAN)), lambda p: _together(p, bands))))
            rows = rows.withColumn("met", F.filter(F.transform("w", lambda m, w: F.when(F.exists(m, may), w)), lambda w: w.isNotNull()))
            rows = rows.withColumn(f"f{c}", F.transform("met", partial(_met, c))).drop("met", "w")
            made.append(f"f{c}")
    return rows.select("doc_id", F.concat(*made).alias("found"))


def _met(c: int, w: Column) -> Column:
    return _candidate(c, w, F.get("w", w))


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, least: float = 0.8, bands: int = 16) -> DataFrame:
    """``doc_id, matches`` for each row of ``docs(doc_id, text)``.

    ``matches`` holds ``license, share, at``: the name, the best share over the
    windows, and the first word (from 0) of the first window with that share.
    """
    known, keys = compiled(docs.sparkSession, templates or TEMPLATES, bands)
    longs, n_keys = 1 << 12, keys.count()
    while longs < MOST_LONGS and longs * 64 < _BITS * n_keys:
        longs *= 2
    classes = sorted(r["c"] for r in known.select("c").distinct().collect())
    # columns of their own: an expression inside a lambda is evaluated for each element
    rows = docs.select("doc_id", words(F.col("text")).alias("ws")).select("doc_id", _shingles(F.col("ws")).alias("sh"))
    rows = _candidates(rows, classes, bands, _bitmap(keys, longs), longs)
    scanned = written(rows.select(F.monotonically_increasing_id().alias("id"), "doc_id", "found"), "scanned")
    each = scanned.select("id", F.explode("found").alias("x")).select("id", "x.c", "x.w", "x.held", "x.keys")
    told = F.when(F.col("c") == 0, F.transform("held", lambda h: F.struct(F.lit(0).alias("j"), h.alias("v")))).otherwise(
        F.transform("keys", lambda v, j: F.struct(j.alias("j"), v.alias("v")))
    )
    each = each.select("id", "c", "w", "held", F.explode(told).alias("k")).select("id", "c", "w", "held", "k.j", "k.v")
    met = each.join(keys, ["c", "j", "v"]).select("id", "c", "w", "held", "license")
    share = F.size(F.array_intersect("held", "t")) / F.col("n")
    at = F.col("w") * BLOCK * F.pow(F.lit(2), F.col("c")).cast("int")
    full = met.join(known.drop("c"), "license").select("id", "license", F.struct(share.alias("share"), (-at).cast("int").alias("back")).alias("s"))
    best = full.where(F.col("s.share") >= least).groupBy("id", "license").agg(F.max("s").alias("s"))
    match = F.struct("license", F.col("s.share").alias("share"), (-F.col("s.back")).alias("at"))
    matches = written(best.groupBy("id").agg(F.array_sort(F.collect_list(match)).alias("matches")), "matches")
    forget(known, keys)
    none = F.array().cast("array<struct<license:string,share:double,at:int>>")
    out = scanned.select("id", "doc_id").join(matches, "id", "left").select("doc_id", F.coalesce("matches", none).alias("matches"))
    return reading(out, scanned, matches)
