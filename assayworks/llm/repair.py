"""Conversation structure repair: the cheapest edits that bring a conversation's roles into a grammar.

Role initials shall read ``(s?(ua)+)?``.  A turn is kept (cost 0), given another role
(2) or deleted (3); an empty user or assistant turn is put in for 2.  Blank turns and
repeats of an earlier turn have to go; a cut-off turn that stays costs 1 more.  Of the
cheapest edits those count whose letters (``K R D I``) are least in ASCII.

Method: a recursive query of DuckDB inside hash-partitioned batches.  Each recursion
advances one turn for all conversations of a batch and keeps, for each state of the
grammar, the least cost and its audit (the letters so far).  A conversation is cut
into segments of at most ``2 ** span_bits`` turn numbers and ``longest`` rows, so one that holds
a third of all rows is many tasks' work: a segment is solved from each state it may
begin in, and further recursions over segments (a few bytes a turn) put them together, some
sixteen at a time, until a conversation has no more than that.

Edits are worked out on rows without their texts: the role's initial, the faults, and a
128-bit digest of role and text.  Equal rows of a turn are one row with a count before
anything is shuffled; repeats are told by the first turn of each digest, a grouped
minimum.  Texts are shuffled once, for :func:`repaired`, and pass its tasks as sorted
streams, a batch at a time; only a conversation's audit is held whole.

Defined cases: nulls of ``role`` and ``text`` are one space.  Rows of a turn number come
in the order of role and digest, null turns first; null ``conv_id`` is one conversation.
A role that begins with no ``s u a`` can only be changed or deleted.  Repeated rows are
repeats of the first.  A conversation of which :func:`damaged` leaves nothing has zeros, an
empty audit and the digest of nothing; an empty table gives an empty one.  Other columns
are not read, whatever their names.  ``gaps`` is null where it exceeds a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import forget, reading, written

#: Characters that make a text blank.
BLANK = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    span_bits: int = 8
    longest: int = 256
    batch: int = 8_192
    #: Segments of a conversation are put together as long as there are more than ``2 ** fan_bits``, so many at a time.
    fan_bits: int = 4


#: States of the grammar: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: What a kept turn of an initial, and a user or assistant turn put in or renamed, leads to.
_KEEP = [("s", START, SYSTEM), ("u", START, USER), ("u", SYSTEM, USER), ("u", ASSISTANT, USER), ("a", USER, ASSISTANT)]
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _moves() -> pa.Table:
    """Every way to deal with a row, followed by up to two turns put in; more lead back and only cost."""
    rows = []

    def add(letter: str, initial: str | None, q: int, to: int, cost: int) -> None:
        for k in range(3 if to in (START, SYSTEM) else 2):
            rows.append({"letter": letter, "initial": initial, "q": q, "to": to, "cost": cost + 2 * k, "more": "I" * k})
            to = _NEXT[to]

    for initial, q, to in _KEEP:
        add("K", initial, q, to, 0)
    for q, to in _NEXT.items():
        add("R", None, q, to, 2)
        add("D", None, q, q, 3)
        add("", None, q, q, 0)  # before the first row
    return pa.Table.from_pylist(rows)


_SEGMENTS = """
with recursive best(seg, q0, q, i, way) using key (seg, q0, q) as (
  select seg, m.q, m."to", 0, struct_pack(cost := m.cost::bigint, audit := m.more) from (select distinct seg from turns), moves m where m.letter = ''
  union
  select b.seg, b.q0, m."to", t.i, min(struct_pack(
    cost := b.way.cost + m.cost + 3 * (t.n - 1) + case when m.letter in ('K', 'R') then t.cut else 0 end,
    audit := b.way.audit || m.letter || repeat('D', (t.n - 1)::int) || m.more))
  from best b join turns t on t.seg = b.seg and t.i = b.i + 1
  join moves m on m.q = b.q and m.letter <> '' and (m.initial is null or m.initial = t.initial) and (m.letter = 'D' or not t.forced)
  group by b.seg, b.q0, m."to", t.i)
select b.seg, list(struct_pack(q0 := b.q0, q := b.q, cost := b.way.cost, audit := b.way.audit) order by b.q0, b.q) as ways
from best b join (select seg, max(i) as last from turns group by seg) s on s.seg = b.seg and s.last = b.i group by b.seg order by b.seg
"""

_MERGED = """
with recursive best(seg, q0, q, j, way) using key (seg, q0, q) as (
  select s.seg, f.q, f.q, 0, struct_pack(cost := 0::bigint, audit := '') from (select distinct seg from segments) s, (select unnest(range(4)) as q) f
  union
  select b.seg, b.q0, s.w.q, s.j, min(struct_pack(cost := b.way.cost + s.w.cost, audit := b.way.audit || s.w.audit))
  from best b join (select seg, j, unnest(ways) as w from segments) s on s.seg = b.seg and s.j = b.j + 1 and s.w.q0 = b.q
  group by b.seg, b.q0, s.w.q, s.j),
whole as (
  select seg, max(j) as n, sum(illegal + (j > 1 and before || first not in ('su', 'ua', 'au'))::bigint)::bigint as illegal, arg_min(first, j) as first, arg_max(last, j) as last
  from (select seg, j, illegal, first, last, lag(last) over (partition by seg order by j) as before from segments) group by seg)
select b.seg, any_value(w.illegal) as illegal, any_value(w.first) as first, any_value(w.last) as last,
  list(struct_pack(q0 := b.q0::int, q := b.q::int, cost := b.way.cost, audit := b.way.audit) order by b.q0, b.q) as ways
from best b join whole w on w.seg = b.seg and w.n = b.j group by b.seg order by b.seg
"""

_CONVERSATIONS = """
with recursive best(conv, q, j, way) using key (conv, q) as (
  select distinct conv, 0, 0, struct_pack(cost := 0::bigint, audit := '') from segments
  union
  select b.conv, s.w.q, s.j, min(struct_pack(cost := b.way.cost + s.w.cost, audit := b.way.audit || s.w.audit))
  from best b join (select conv, j, unnest(ways) as w from segments) s on s.conv = b.conv and s.j = b.j + 1 and s.w.q0 = b.q
  group by b.conv, s.w.q, s.j)
select c.conv, c.illegal, way.cost as cost, way.audit as audit
from (select b.conv, min(b.way) as way from best b join (select conv, max(j) as last from segments group by conv) l on l.conv = b.conv and l.last = b.j
      where b.q in (0, 3) group by b.conv) join
  (select conv, sum(illegal + (j > 1 and before || first not in ('su', 'ua', 'au'))::bigint)::bigint as illegal
   from (select conv, j, illegal, first, lag(last) over (partition by conv order by j) as before from segments) group by conv) c using (conv)
order by c.conv
"""


def _solver() -> Callable[[str, dict[str, pa.Table]], pa.Table]:
    """A database of one task: tables are looked at where they are, for one query at a time."""
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})

    def solve(sql: str, tables: dict[str, pa.Table]) -> pa.Table:
        for name, held in tables.items():
            con.register(name, held)
        out = con.sql(sql).to_arrow_table()
        for name in tables:
            con.unregister(name)
        return out

    return solve


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int, longest: int | None) -> Iterator[tuple[pa.Table, list[int], list[int]]]:
    """Tables of about ``most`` rows of a sorted stream, whole groups each, with a group's number and place for each row.

    With ``longest``, a group ends after so many rows and goes on as another.
    """
    held: list[pa.RecordBatch] = []
    group: list[int] = []
    place: list[int] = []
    last: tuple | None = None
    for b in batches:
        cut = 0
        for r, key in enumerate(zip(*(b.column(k).to_pylist() for k in keys), strict=True)):
            if group and key == last and (longest is None or place[-1] < longest):
                group.append(group[-1])
                place.append(place[-1] + 1)
                continue
            if len(group) >= most:
                yield pa.Table.from_batches([*held, b.slice(cut, r - cut)]), group, place
                held, group, place, cut = [], [], [], r
            group.append(group[-1] + 1 if group else 0)
            place.append(1)
            last = key
        if cut < b.num_rows:
            held.append(b.slice(cut))
    if group:
        yield pa.Table.from_batches(held), group, place


def _solved(batches: Iterator[pa.RecordBatch], given: Settings) -> Iterator[pa.RecordBatch]:
    """The segments of a sorted stream of turns, with the cheapest way from each state to each."""
    solve, moves, sub = _solver(), _moves(), 0
    last: tuple | None = None
    for rows, seg, place in _groups(batches, ["conv_id", "part"], given.batch, given.longest):
        turns = pa.table(
            {"seg": pa.array(seg, pa.int32()), "i": pa.array(place, pa.int32())} | {c: rows[c] for c in ("initial", "forced", "cut", "n")}
        )
        found = solve(_SEGMENTS, {"turns": turns, "moves": moves})
        initial, n = rows["initial"].to_pylist(), rows["n"].to_pylist()
        heads = [k for k, p in enumerate(place) if p == 1]
        out = []
        for k, (a, b, ways) in enumerate(zip(heads, [*heads[1:], len(place)], found["ways"].to_pylist(), strict=True)):
            key = (rows["conv_id"][a].as_py(), rows["part"][a].as_py())
            sub = sub + 1 if key == last else 0
            last = key
            bad = sum(n[r] - 1 + (r > a and initial[r - 1] + initial[r] not in ("su", "ua", "au")) for r in range(a, b))
            # two equal rows side by side never fit: their initials are the same
            out.append({"conv_id": key[0], "part": key[1], "sub": sub, "illegal": bad, "first": initial[a], "last": initial[b - 1], "ways": ways})
        yield pa.RecordBatch.from_pylist(out, _SEGMENT)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring segments of a sorted stream as one, with the cheapest way from each state to each; few at a time, as audits get long."""
    solve = _solver()
    for rows, seg, place in _groups(batches, ["conv_id", "part", "sub"], 64, None):
        segments = pa.table({"seg": pa.array(seg, pa.int32()), "j": pa.array(place, pa.int32())} | {c: rows[c] for c in ("illegal", "first", "last", "ways")})
        found = solve(_MERGED, {"segments": segments})
        heads = rows.select(["conv_id", "part", "sub"]).take(pa.array([k for k, p in enumerate(place) if p == 1], pa.int64()))
        columns = [*(heads[c] for c in ("conv_id", "part", "sub")), *(found[c] for c in ("illegal", "first", "last", "ways"))]
        yield pa.RecordBatch.from_arrays([c.combine_chunks().cast(f.type) for c, f in zip(columns, _SEGMENT, strict=True)], schema=_SEGMENT)


def _joined(batches: Iterator[pa.RecordBatch], given: Settings) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a sorted stream of segments."""
    solve = _solver()
    for rows, conv, place in _groups(batches, ["conv_id"], given.batch, None):
        segments = pa.table({"conv": pa.array(conv, pa.int32()), "j": pa.array(place, pa.int32())} | {c: rows[c] for c in ("illegal", "first", "last", "ways")})
        found = solve(_CONVERSATIONS, {"segments": segments})
        ids = rows["conv_id"].take(pa.array([k for k, p in enumerate(place) if p == 1], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids.combine_chunks().cast(pa.int64()), *(found[c].combine_chunks() for c in ("illegal", "cost", "audit"))], schema=_CONVERSATION)


_WAY = pa.list_(pa.struct([("q0", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("sub", pa.int32()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("ways", _WAY)])
_CONVERSATION = pa.schema([("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
_SEGMENT_SQL = "conv_id long, part long, sub int, illegal long, first string, last string, ways array<struct<q0: int, q: int, cost: long, audit: string>>"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation; a conversation's audit comes first, then its turns in order, then the next one's audit."""
    held: list | None = None  # id, audit, place in it, state, hash, whether a line has been written

    def put(line: str) -> None:
        held[4].update(("\n" if held[5] else "").encode() + line.encode())
        held[5] = True

    def put_in() -> None:
        while held[2] < len(held[1]) and held[1][held[2]] == "I":
            held[2] += 1
            held[3] = _NEXT[held[3]]
            put(_ROLE[held[3]] + ":")

    for b in batches:
        out = []
        for conv, audit, role, text, n in zip(*(b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "n")), strict=True):
            if audit is not None:
                if held is not None:
                    out.append((held[0], held[4].hexdigest()))
                held = [conv, audit, 0, START, hashlib.sha256(), False]
                put_in()
                continue
            for _ in range(n):
                letter = held[1][held[2]]
                held[2] += 1
                if letter != "D":
                    held[3] = SYSTEM if letter == "K" and role[:1] == "s" else _NEXT[held[3]]
                    put((role if letter == "K" else _ROLE[held[3]]) + ":" + text)
                put_in()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([h for _, h in out], pa.string())], ["conv_id", "repaired_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[4].hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])


def damaged(convs: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n``: rows after damage by a checksum of ``conv_id:turn``; ``n`` is how often a row is there, 0 if it is dropped."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return convs.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))


def _turns(rows: DataFrame) -> DataFrame:
    """Distinct turns of each conversation without their texts: ``role, digest, initial, n, blank, cut, forced``."""
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    facts = _with_digest(rows).withColumns({"blank": end == "", "cut": ~F.right(end, F.lit(1)).isin(".", "!", "?")}).drop("text")
    turns = written(facts.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("n").alias("n")), "turns")
    # a struct of nulls first: the least turn of a digest, one without a number before all
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("at"))
    firsts = turns.where("n > 0").groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(place).alias("_first"))
    joined = turns.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    later = F.col("_first") != place
    # of a role: what the grammar reads, and its first character
    out = written(
        joined.select(
            "conv_id", "turn", "role", "digest", "n", F.left("role", F.lit(1)).alias("initial"), "blank", (~F.col("blank") & later).alias("later"),
            (F.col("blank") | later).alias("forced"), (F.col("cut") & ~F.col("blank") & ~later).cast("int").alias("cut"),
        ),
        "faults",
    )
    forget(turns)
    return out


def _fewer(segments: DataFrame, given: Settings) -> DataFrame:
    """A written table of at most ``2 ** fan_bits`` segments a part, and parts a conversation."""
    keys = ["conv_id", "part", "sub"]
    while True:
        parts = segments.groupBy("conv_id", "part").agg(F.count("*").alias("subs"))
        most = parts.groupBy("conv_id").agg(F.max("subs").alias("subs"), F.count("*").alias("parts")).agg(F.max("subs"), F.max("parts")).head()
        if max(most[0] or 0, most[1] or 0) <= 1 << given.fan_bits:
            return segments
        old = segments.withColumnsRenamed({"part": "_part", "sub": "_sub"})
        if most[0] > 1 << given.fan_bits:  # segments of one part first, then neighbouring parts
            named = old.withColumns({"part": F.col("_part"), "sub": F.shiftright("_sub", given.fan_bits)})
        else:
            named = old.withColumns({"part": F.shiftright("_part", given.fan_bits), "sub": F.lit(0)})
        dealt = named.repartition(*keys).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in (*keys, "_part", "_sub")))
        wide = written(dealt.select(*keys, "illegal", "first", "last", "ways").mapInArrow(_merged, _SEGMENT_SQL), "segments")
        forget(segments)
        segments = wide


def _counts(turns: DataFrame) -> DataFrame:
    """A row for each conversation that was there before the damage."""
    there = F.col("n") > 0
    turn = F.when(there, F.col("turn"))
    repeats = F.when(F.col("later"), F.col("n")).when(~F.col("blank"), F.col("n") - 1).otherwise(0)
    named = turns.groupBy("conv_id", "turn").agg(
        F.max(turn).alias("_turn"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(there, repeats).otherwise(0)).alias("duplicate"), F.sum(F.when(there, F.col("cut")).otherwise(0)).alias("truncated"),
    )
    wide = lambda c: c.cast("decimal(20)")
    gaps = (wide(F.max("_turn")) - wide(F.min("_turn")) + 1 - F.count("_turn")).cast("decimal(22)")
    return named.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).try_cast("long").alias("gaps"), *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated"))
    )


def solved(rows: DataFrame, given: Settings = Settings()) -> DataFrame:
    """The cheapest edits of each conversation of :func:`damaged`: counts of faults, ``illegal``, ``cost`` and ``audit``."""
    turns = _turns(rows)
    part = F.shiftright("turn", given.span_bits)
    dealt = turns.where("n > 0").withColumn("part", part).repartition("conv_id", "part")
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("part").asc_nulls_first(), *_order())
    segments = ordered.select("conv_id", "part", "initial", "forced", "cut", "n").mapInArrow(partial(_solved, given=given), _SEGMENT_SQL)
    segments = _fewer(written(segments, "segments"), given)
    again = segments.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("part").asc_nulls_first(), "sub")
    edits = again.mapInArrow(partial(_joined, given=given), "_conv long, illegal long, cost long, audit string")
    counts = _counts(turns)
    out = counts.join(edits, counts["conv_id"].eqNullSafe(edits["_conv"]), "left").drop("_conv")
    filled = written(out.fillna(0, ["illegal", "cost"]).fillna("", ["audit"]), "edits")
    forget(turns, segments)
    return filled


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the lines ``role:text`` that the edits leave."""
    none = F.lit(None)
    heads = edits.select("conv_id", F.lit(0).alias("kind"), "audit", none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).cast("long").alias("n"), none.cast("string").alias("digest"))
    lines = _with_digest(rows.where("n > 0")).select("conv_id", F.lit(1).alias("kind"), none.cast("string").alias("audit"), "turn", "role", "text", "n", "digest")
    ordered = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *_order())
    return ordered.select("conv_id", "audit", "role", "text", "n").mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def repair(convs: DataFrame, given: Settings = Settings()) -> DataFrame:
    """Faults, cheapest edits and digest of each conversation of ``convs(conv_id, turn, role, text)`` after :func:`damaged`."""
    rows = damaged(convs)
    edits = solved(rows, given)
    lines = repaired(rows, edits).withColumnRenamed("conv_id", "_conv")
    out = edits.join(lines, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return reading(out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), edits)
