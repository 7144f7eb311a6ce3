"""Concurrency sweep, conversation repair and source mixing against plain Python."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assayworks.llm import mixing, repair, sweep


def plain_sweep(spans, total):
    moves = {}
    for key, a, b, amount in spans:
        if a is None or (b is not None and b <= a):
            continue
        for k in (key, total):
            for at, sign in ((a, 1), (b, -1)):
                if at is not None:
                    m = moves.setdefault((k,), {}).setdefault(at, [0, 0])
                    m[0] += sign
                    m[1] += sign * (amount or 0)
    out = []
    for (key,), by in moves.items():
        n = c = high = 0
        rows = []
        kept = sorted(at for at, (x, y) in by.items() if x or y)
        for i, at in enumerate(kept):
            n, c = n + by[at][0], c + by[at][1]
            high = n if not i else max(high, n)
            rows.append([key, at, kept[i + 1] if i + 1 < len(kept) else None, n, c, high])
        top = max((r[3] for r in rows), default=None)
        out += [(*r, r[3] == top) for r in rows]
    return sorted(out, key=repr)


def test_sweep(spark):
    rng = random.Random(4)
    spans = [(rng.choice([1, 1, 1, 2, -2, None]), a := 60 * rng.randrange(-3000, 6000), rng.choice([None, a, a + 60 * rng.randrange(1, 4000)]), rng.choice([None, 0, 5, 700])) for _ in range(400)]
    spans += [(3, None, 60, 1), (3, 120, 60, 1), (4, 0, 60, 7), (4, 60, 120, 7), *[(5, 600, 660, 1)] * 50]
    df = spark.createDataFrame(spans, "key int, start_s long, stop_s long, amount long").withColumn("day", F.lit("clash"))
    got = sorted((tuple(r) for r in sweep.sweep(df, total=-2).collect()), key=repr)
    assert got == plain_sweep(spans, -2)
    assert sweep.sweep(df.where("false"), total=-2).count() == 0 and sweep.sweep(df).where("key = -2 and from_s < 0").count() >= 0
    (row,) = sweep.sweep(df.where("key = 4")).where("from_s = 0").collect()  # one ends as the other starts: no row at 60
    assert row["to_s"] == 120 and row["n_open"] == 1 and row["is_peak"]


def test_open_sales(spark):
    day = datetime(2024, 2, 1, 10, 30, 59, 999_999)
    sales = [(1, 10, 12.345, day), (2, 11, None, day), (3, None, 5.0, day), (4, 10, float("nan"), day), (5, 10, 1.0, None), (6, 99, 1.0, day), (7, 10, -0.005, day), (7, 10, -0.005, day)]
    lines = [(1, day), (1, day + timedelta(hours=1)), (1, None), (2, day - timedelta(days=8)), (None, day), (6, day - timedelta(days=7)), (3, day)]
    clients = [(10, 3), (10, 5), (11, 4), (None, 9), (12, None)]
    df = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("key", F.lit(1)).withColumn("nation", F.lit(2))
    spans = sweep.open_sales(
        df(sales, "sale_id long, client_id long, total double, sold_at timestamp_ntz"), df(lines, "sale_id long, shipped_at timestamp_ntz"), df(clients, "client_id long, nation_id int")
    )
    start = int((datetime(2024, 2, 1, 10, 30) - datetime(1970, 1, 1)).total_seconds())
    got = sorted((tuple(r) for r in spans.collect()), key=repr)
    week = 7 * 86_400
    assert got == sorted([(3, start, start + 3600 + week, 1235), (-1, start, start + week, 500), (3, start, None, 0), (3, start, None, 0), (3, start, None, 0)], key=repr)
    old = spark.createDataFrame([(datetime(1969, 12, 31, 23, 58, 59, 500_000),)], "t timestamp_ntz")
    assert old.select(sweep.seconds(F.col("t"))).first()[0] == -120


# --- conversation repair

NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}
NAMES = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()


def plain_faults(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[2], r[3])))
    seen, out = set(), []
    for _, _, role, text in rows:
        t = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return rows, out


def search(rows):
    """Cheapest edits by search in the order of cost and letters, a step at a time."""
    heap = [(0, "", 0, 0, ())]
    done = set()
    while heap:
        cost, audit, i, q, lines = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit, "\n".join(lines)
        u = NEXT[q]
        heapq.heappush(heap, (cost + 2, audit + "I", i, STATE[u], (*lines, NAMES[u] + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] == u or (role[:1] == "s" and q == 0):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, STATE[role[:1]], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, STATE[u], (*lines, f"{NAMES[u]}:{text}")))
    raise AssertionError


def every_edit(rows):
    """The same over all edits there are, with up to two turns put in at a place, held against the grammar by a pattern."""
    puts = ["", "u", "a", "ua", "au"]
    ways = []
    for role, _, fault in rows:
        more = fault == "truncated"
        kept = [] if fault in ("blank", "duplicate") else [("K", role[:1] or "-", more), ("R", "u", 2 + more), ("R", "a", 2 + more)]
        ways.append([("D", "", 3), *kept])
    best = None
    for steps in itertools.product(*ways):
        for more in itertools.product(puts, repeat=len(rows) + 1):
            roles = more[0] + "".join(s[1] + m for s, m in zip(steps, more[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                cost = sum(s[2] for s in steps) + 2 * sum(map(len, more))
                audit = "I" * len(more[0]) + "".join(s[0] + "I" * len(m) for s, m in zip(steps, more[1:], strict=True))
                best = min(best or (cost, audit), (cost, audit))
    return best


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        left, faults = plain_faults([r for r in plain_damage(rows) if r[0] == conv])
        cost, audit, text = search(faults)
        turns = [r[1] for r in left if r[1] is not None]
        initials = [r[0][:1] for r in faults]
        count = lambda k: sum(f[2] == k for f in faults)  # noqa: E731, B023
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations():
    rng = random.Random(12)
    texts = ["Hello.", "Yes!", "Why?", "cut off", "", " \t\n", None, "Hello. \n", "é…", "a" * 3000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"]
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(rng.choice([1, 1, 3, 6, 12])):
            at = rng.choice([turn, turn, turn, None, 2 * turn, 3])
            rows += [(conv, at, rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 3])
    return rows


@pytest.mark.parametrize("given", [repair.Settings(), repair.Settings(span_bits=1, longest=2, batch=16, fan_bits=1)])
def test_repair(spark, given):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV).withColumn("n", F.lit("clash")).withColumn("audit", F.lit(1))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repair(df.repartition(3), given).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    assert not {k: (got[k], want[k]) for k in want if got[k] != want[k]}
    assert repair.repair(df.where("false"), given).count() == 0


def test_search_against_every_edit():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), "x", rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randint(0, 3))]
        assert search(rows)[:2] == every_edit(rows)


def test_repair_one_long_conversation(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"text {t}.", f"text {t}", "Same."])) for t in range(-1500, 1500)]
    rows += [(8, 1, "user", f"{k}.") for k in range(700)]  # many rows of one turn
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repair(spark.createDataFrame(rows, CONV), repair.Settings(span_bits=5, longest=20, fan_bits=2)).collect()}
    assert got == expected(rows)


# --- mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return out


def test_mixing(spark):
    rng = random.Random(6)
    names = [None, "", "z", "Z", "é", "😀", "￮", *(f"s{k}" for k in range(30))]
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(names[: 7 + i % 31])) for i in range(6000)]
    rows += [(6000, None, "z"), (6001, "", "none"), (None, "a b", "z"), (None, "a b", "z"), (6002, "\x0b a\tb c\x1f \n", "s1"), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash")).withColumn("_source", F.lit(1))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    want = plain_targets(sizes)
    got = mixing.taken(df).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((i, count(t)) for i, t, _ in rows), key=repr)
    source = {i: s for i, _, s in rows}
    by = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["taken"] == r["size"] * r["copies"] and int(rate) <= r["copies"] <= min(2, int(rate) + 1)
        by[s] = by.get(s, 0) + r["taken"]
    for s, target in want.items():  # six times the deviation of the draws
        rate = target / sizes[s] if sizes[s] else 0
        spread = sum(count(t) ** 2 for _, t, x in rows if x == s) * (rate % 1) * (1 - rate % 1)
        assert abs(by[s] - target) <= 6 * spread**0.5 + 1e-6
    assert sorted(map(repr, mixing.taken(df.repartition(7), mixing.Settings(broadcast_sources=0)).collect())) == sorted(map(repr, got))
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "copy"]
    many = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    counts = {}
    for r in got:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + r["copies"]
    assert many == {k: v for k, v in counts.items() if v}
    assert mixing.taken(df.where("false")).count() == 0 and mixing.mix(df.where("false")).count() == 0
    empty = mixing.taken(df.where("text is null or text = ''")).collect()
    assert empty and all(r["target"] == 0 and r["taken"] == 0 for r in empty)
