"""Personal data, and the terms that give it away.

Base spans are e-mail addresses, IP addresses, payment cards and telephone
numbers, found by pattern in whole texts.  Secrets are runs of 16 letters and digits or more
that go from one to the other and back: at five bits a sign that is more than any word carries.
All these are protected values (entities).

Information-theoretic sanitisation adds the terms that reveal them, by co-occurrence over
distinct whole texts, in two ways:

- a term reveals a kind of entity by ``P(kind | term)``, the share of the texts with the term
  that hold an entity of the kind; it has to go with at least ``values`` different ones, so that
  near copies of a text are no evidence (a cue such as ``password``);
- a term that stands within ``reach`` characters of an entity in at least ``support`` texts
  reveals this one by ``P(entity | term)`` (a name, a nickname).

A term is masked wherever it occurs if the share reaches ``disclosure`` and the term raises
the probability by ``bits`` bits.  From ``removal`` on it is removed, below that generalised to
the kind of value it discloses.  Terms inside entities are no candidates.

Counts cover all texts; exact copies count once.  Base spans stay within a row; the
statistics are grouped aggregations.  Terms that are in too many texts to disclose
anything go first, by counts over the texts that hold entities; only for those left
all texts are counted.  Tables that are broadcast are counted before; beyond
``broadcast_terms`` and the like they are joined by shuffle, with equal results.
DataFrame and SQL functions only.

Defined cases: a null text is empty and stays null when sanitised.  Repeated rows
each get the same spans.  Spans that begin at one place come in the order of kinds.
Overlapping spans are masked as one, by the first of them.  An empty table gives an
empty one.  Extra columns of any name are carried through by :func:`sanitise`.  Time
is linear in a text's matches but for sums within blocks of 128 of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text, forget, reading, release, written

#: Kinds in their order, and Java patterns.  Possessive loops and the start conditions change no
#: match; they keep the time linear in the text and the stack flat.  Runs of under 14 digits can be no card.
KINDS = ("email", "ip", "card", "phone", "secret", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERN = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![\p{L}\p{N}])[A-Za-z0-9]{16,}+(?![\p{L}\p{N}])",
}
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_WORD = r"[\p{L}\p{N}]+"
#: ``rank``: the kind; of terms 5 and the kind that they disclose, or 10 if they go.
_SPAN = "array<struct<start:int,rank:int,stop:int>>"
_SECRET, _TERM, _GONE = 4, 5, 10
_BLOCK = 128
#: Masked terms that are looked for by one pattern.
_NAMED = 200


@dataclass(frozen=True)
class Disclosure:
    reach: int = 80
    support: int = 3
    values: int = 5
    disclosure: float = 0.8
    bits: float = 3.0
    removal: float = 0.95
    #: Rows that may be broadcast: of terms, and of text keys (16 bytes each).
    broadcast_terms: int = 200_000
    broadcast_texts: int = 500_000
    #: Spans (12 bytes each) that may be broadcast with their texts' keys.
    broadcast_spans: int = 1_000_000
    shortest: int = 3


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.ascii(F.substring(back, i, F.lit(1))) - 48
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i))
    return total % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        digits = F.translate(found, " -", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(found, " ().-+", "")).between(10, 15)
    if kind == "secret":
        return found.rlike("[0-9][A-Za-z]") & found.rlike("[A-Za-z][0-9]")
    return F.lit(True)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once, not for each element of a lambda in it."""
    return F.transform(F.array(value), then)[0]


def _located(text: Column, pattern: str, rank: Callable[[Column], Column]) -> Column:
    """Spans of the matches of a pattern that have a rank.

    Gaps and matches alternate, so their lengths give the places: sums up to each
    block of matches, then sums within the block.
    """

    def add(a: Column, e: Column) -> Column:
        return a + e.gap + e.size

    def sums(steps: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))
        own = F.transform(blocks, lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), add))
        first = F.array(F.lit(0))
        return F.aggregate(own, first, lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))

    def spans(steps: Column, begin: Column) -> Column:
        def span(e: Column, i: Column) -> Column:
            b = F.floor(i / _BLOCK).cast("int")
            start = F.aggregate(F.slice(steps, b * _BLOCK + 1, i % _BLOCK), F.get(begin, b), add) + e.gap
            return F.struct(start.alias("start"), e["rank"].alias("rank"), (start + e.size).alias("stop"))

        return F.filter(F.transform(steps, span), lambda s: s["rank"].isNotNull())

    def step(p: Column) -> Column:
        return F.transform(
            p.found, lambda x, i: F.struct(F.length(F.get(p.gaps, i)).alias("gap"), F.length(x).alias("size"), rank(x).cast("int").alias("rank"))
        )

    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    some = lambda steps: F.when(F.size(steps) > 0, _let(sums(steps), lambda begin: spans(steps, begin))).otherwise(F.array().cast(_SPAN))
    return _let(pieces, lambda p: _let(step(p), some))


def _ranked(kind: str, rank: int, found: Column) -> Column:
    return F.when(_valid(kind, found), F.lit(rank))


def base_spans(text: Column) -> Column:
    """All base spans of a text in order of start, then kind."""
    none = F.array().cast(_SPAN)
    may = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(_PATTERN["card"]),
        "phone": text.rlike(r"\+[0-9]"),
    }
    each = [
        F.when(may[k], _located(text, _PATTERN[k], partial(_ranked, k, i))).otherwise(none)
        for i, k in enumerate(KINDS[:4])
    ]
    return F.array_sort(F.concat(*each))


def secret_spans(text: Column) -> Column:
    """Spans of keys, tokens and passwords that no word looks like."""
    found = _located(text, _PATTERN["secret"], partial(_ranked, "secret", _SECRET))
    return F.when(text.rlike("[0-9][A-Za-z]"), found).otherwise(F.array().cast(_SPAN))


def _outside(text: Column, spans: Column) -> Column:
    """The text without its entities, a stop for each."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        gap = F.when(s.start > a.at, F.substring(text, a.at + 1, s.start - a.at)).otherwise("")
        return F.struct(F.greatest(a.at, s.stop).alias("at"), F.concat(a.parts, F.array(gap)).alias("parts"))

    return F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a.parts, "."), F.lit("."), F.substring(text, a.at + 1, F.length(text))))


def _terms(part: Column, shortest: int, skip: Column | None = None, spare: Column | None = None) -> Column:
    """Terms of a text; ``skip`` and ``spare`` say that the first or last piece is cut and goes, whatever it is."""
    found = F.split(F.lower(part), r"[^\p{L}\p{N}]+")
    if skip is not None:
        found = F.when(skip, F.slice(found, F.lit(2), F.size(found))).otherwise(found)
    if spare is not None:
        found = F.when(spare, F.slice(found, F.lit(1), F.size(found) - 1)).otherwise(found)
    return F.filter(found, lambda w: (F.length(w) >= shortest) & w.rlike(r"^[\p{L}\p{N}]*\p{L}"))


def _words(text: Column) -> Column:
    """Distinct words of a text, those that are no terms as well: for joins with terms."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


KEY = ["h", "g"]


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.reverse(text), F.length(text)).alias("g")]


def _beside(text: Column, s: Column, reach: int, shortest: int) -> Column:
    """Terms within reach of a span; words that the window cuts are left out."""
    begin = F.greatest(s.start - reach, F.lit(0))
    left = _terms(F.substring(text, begin + 1, s.start - begin), shortest, skip=_inside(text, begin))
    end = s.stop + reach
    right = _terms(F.substring(text, s.stop + 1, F.lit(reach)), shortest, spare=_inside(text, end))
    return F.array_distinct(F.concat(left, right))


def _inside(text: Column, at: Column) -> Column:
    """Whether a word goes on across this place."""
    return (at > 0) & F.substring(text, at, F.lit(2)).rlike(r"^[\p{L}\p{N}]{2}$")


def _entity(text: Column, s: Column) -> Column:
    value = F.substring(text, s.start + 1, s.stop - s.start)
    return F.concat(s["rank"].cast("string"), F.lit(":"), F.when(s["rank"] == 0, F.lower(value)).when(s["rank"] == _SECRET, value).otherwise(F.regexp_replace(value, "[^0-9.]", "")))


def _bounded(df: DataFrame, most: int) -> DataFrame:
    """Broadcast a table of that few rows; join a longer one by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def disclosing_terms(based: DataFrame, texts: DataFrame, d: Disclosure) -> DataFrame | None:
    """Masked terms ``term, share, kind``; none if nothing is a candidate.

    ``based(h, g, beside, words)`` holds, for each row, its entities with the terms beside
    them, and its terms outside of them (both null without entities), ``texts(text, h, g)`` all texts.
    """
    by_text = written(based.groupBy(*KEY).agg(F.count("*").alias("copies")), "copies")
    n_all = max(1, by_text.count())
    held = written(based.where("beside is not null").select(*KEY, "beside", "words").dropDuplicates(KEY), "held")
    near = F.array_distinct(F.flatten(F.transform("beside", lambda x: F.transform(x.terms, lambda t: F.struct(t.alias("term"), x.entity.alias("entity"))))))
    near = held.select(F.explode(near).alias("x")).groupBy("x.term", "x.entity").agg(F.count("*").alias("n_near")).where(F.col("n_near") >= d.support)
    entities = held.select(*KEY, F.explode(F.array_distinct("beside.entity")).alias("entity"))
    n_entity = entities.groupBy("entity").agg(F.count("*").alias("n_entity"))
    # n_both is at most n_entity, and n_term at least what the texts with entities have
    n_held = held.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_held"))
    able = (F.col("n_entity") >= d.disclosure * F.col("n_held")) & (F.log2(F.lit(float(n_all)) / F.greatest("n_entity", "n_held")) >= d.bits)
    near = written(near.join(n_entity, "entity").join(n_held, "term").where(able).select("term", "entity", "n_entity"), "near")
    kinds = written(_by_kind(held, n_held, n_all, d), "kinds")
    wanted = written(near.select("term").union(kinds.select("term")).distinct(), "wanted")
    if not wanted.head(1):
        forget(by_text, held, near, kinds, wanted)
        return None
    terms = held.select(*KEY, F.explode("words").alias("term")).join(_bounded(wanted, d.broadcast_terms), "term", "left_semi")
    both = terms.join(near, "term").join(entities, [*KEY, "entity"], "left_semi")
    pairs = both.groupBy("term", "entity", "n_entity").agg(F.count("*").alias("n_both"))
    copied = by_text.where("copies > 1")
    # each of c equal texts counts 1/c, so sums count distinct texts and combine before the shuffle
    weighed = texts.join(_bounded(copied, d.broadcast_texts), KEY, "left")
    every = weighed.select((1 / F.coalesce("copies", F.lit(1))).alias("w"), F.explode(_words(F.col("text"))).alias("term"))
    n_term = every.join(_bounded(wanted, d.broadcast_terms), "term", "left_semi").groupBy("term").agg(F.round(F.sum("w")).alias("n_term"))
    share = F.col("n_both") / F.col("n_term")
    gain = F.log2(share / (F.col("n_entity") / F.lit(float(n_all))))
    each = pairs.select("term", F.substring("entity", 1, 1).cast("int").alias("kind"), "n_entity", "n_both").unionByName(kinds)
    told = each.join(n_term, "term").where((share >= d.disclosure) & (gain >= d.bits))
    best = F.max(F.struct(share.alias("share"), (-F.col("kind")).alias("back"))).alias("best")
    told = written(told.groupBy("term").agg(best).select("term", "best.share", (-F.col("best.back")).alias("kind")), "told")
    forget(by_text, held, near, kinds, wanted)
    if told.head(1):
        return told
    forget(told)
    return None


def _by_kind(held: DataFrame, n_held: DataFrame, n_all: int, d: Disclosure) -> DataFrame:
    """Terms that may reveal a kind of entity: ``term, kind, n_entity, n_both``; counts are of distinct texts.

    A text stands for one value of each kind that it holds, the least by hash, so pairs stay in
    proportion to its terms.
    """

    def stands(kind: int) -> Column:
        own = F.filter("beside", lambda x: x.entity.startswith(f"{kind}:"))
        return F.struct(F.lit(kind).alias("kind"), F.array_min(F.transform(own, lambda x: F.xxhash64(x.entity))).alias("value"))

    some = F.array(*map(stands, range(_TERM)))
    kinds = held.select("words", F.explode(F.filter(some, lambda x: x.value.isNotNull())).alias("x"))
    n_kind = kinds.groupBy(F.col("x.kind").alias("kind")).agg(F.count("*").alias("n_entity"))
    pairs = kinds.select("x.kind", "x.value", F.explode("words").alias("term")).groupBy("term", "kind", "value").agg(F.count("*").alias("n"))
    both = pairs.groupBy("term", "kind").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_values")).where(F.col("n_values") >= d.values)
    able = (F.col("n_both") >= d.disclosure * F.col("n_held")) & (F.log2(F.lit(float(n_all)) / F.col("n_entity")) >= d.bits)
    return both.join(n_held, "term").join(F.broadcast(n_kind), "kind").where(able).select("term", "kind", "n_entity", "n_both")


def _term_spans(texts: DataFrame, told: DataFrame, d: Disclosure) -> DataFrame:
    """``h, g, extra``: the spans of masked terms in each distinct text that has any."""
    names = [r["term"] for r in told.select("term").limit(_NAMED + 1).collect()]
    if len(names) <= _NAMED:  # few enough to look for them before words are told apart; spares rows, changes no span
        texts = texts.where(F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(sorted(names))})(?![\p{{L}}\p{{N}}])"))
    every = texts.select(*KEY, F.explode(_words(F.col("text"))).alias("term"))
    rank = F.when(F.col("share") < d.removal, F.col("kind") + _TERM).otherwise(_GONE)
    there = every.join(_bounded(told.select("term", rank.alias("rank")), d.broadcast_terms), "term")
    there = written(there.groupBy(*KEY).agg(F.collect_set(F.struct("term", "rank")).alias("ranks")), "there")
    held = texts.join(_bounded(there.select(*KEY), d.broadcast_texts), KEY, "left_semi")
    held = held.dropDuplicates(KEY).join(there, KEY).select(*KEY, "text", F.map_from_entries("ranks").alias("ranks"))
    extra = _located(F.col("text"), _WORD, lambda x: F.try_element_at(F.col("ranks"), F.lower(x)))
    extra = written(held.select(*KEY, extra.alias("extra")), "extra", few=False)
    forget(there)
    return extra


def detected(docs: DataFrame, d: Disclosure | None = None) -> DataFrame:
    """``doc_id, base, extra`` (secrets and terms) and the text's key for each row of ``docs(doc_id, text)``."""
    d = d or Disclosure()
    texts = docs.select(as_text(F.col("text")).alias("text"))
    texts = texts.select("text", *_text_key(F.col("text")))
    rows = docs.select("doc_id", as_text(F.col("text")).alias("text")).select("doc_id", "text", base_spans(F.col("text")).alias("base"), secret_spans(F.col("text")).alias("secret"))
    rows = rows.withColumn("entities", F.array_sort(F.concat("base", "secret")))
    beside = F.transform(
        "entities", lambda s: F.struct(_entity(F.col("text"), s).alias("entity"), _beside(F.col("text"), s, d.reach, d.shortest).alias("terms"))
    )
    some = F.size("entities") > 0
    words = F.when(some, F.array_distinct(_terms(_outside(F.col("text"), F.col("entities")), d.shortest))).alias("words")
    based = written(rows.select("doc_id", *_text_key(F.col("text")), "base", "secret", F.when(some, beside).alias("beside"), words), "base")
    told = disclosing_terms(based, texts, d)
    slim = based.drop("beside", "words")
    if told is None:
        return reading(slim.withColumnRenamed("secret", "extra"), based)
    extra = _term_spans(texts, told, d)
    forget(told)
    # both sides are plain tables: a text of very many rows is a skewed join that AQE splits
    return reading(slim.join(extra, KEY, "left").withColumn("extra", F.concat("secret", F.coalesce("extra", F.array().cast(_SPAN)))).drop("secret"), based, extra)


def _named(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), F.least(s["rank"], F.lit(_TERM)) + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s.start.cast("string"), s.stop.cast("string"))), ",")


def report(docs: DataFrame, d: Disclosure | None = None) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, their digest, all spans as text, of these secrets and terms, and whether there are any."""
    found = detected(docs, d)
    count = lambda k: F.size(F.filter(whole, lambda s: F.least(s["rank"], F.lit(_TERM)) == k)).cast("long").alias(f"n_{KINDS[k]}")
    whole = F.array_sort(F.concat("base", "extra"))
    out = found.select(
        "doc_id", *map(count, range(4)), F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(whole).alias("spans"),
        count(_SECRET), count(_TERM), (F.size(whole) > 0).alias("sensitive"),
    )
    return reading(out, found)


#: What stands for a masked span, by rank.
MASKS = [*(f"[{k.upper()}]" for k in KINDS[:_TERM]), *(f"[{k.upper()} TERM]" for k in KINDS[:_TERM]), ""]


def sanitise(docs: DataFrame, d: Disclosure | None = None) -> DataFrame:
    """``docs`` with masked texts: ``[EMAIL]`` and so on, ``[EMAIL TERM]`` or nothing for terms; other columns as they are."""
    d = d or Disclosure()
    told = detected(docs, d)
    found = told.select(*KEY, F.array_sort(F.concat("base", "extra")).alias("spans"))
    found = written(found.where(F.size("spans") > 0).dropDuplicates(KEY), "spans")
    release(told)
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    keyed = docs.select(row, *_text_key(as_text(F.col("text"))))
    # spans are small; only more texts with spans than may be broadcast make the texts move
    n_spans = found.agg(F.sum(F.size("spans") + 2)).head()[0] or 0
    held = keyed.join(F.broadcast(found) if n_spans <= d.broadcast_spans else found, KEY, "left")
    masks = F.array(*map(F.lit, MASKS))
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        fresh = s.start >= a.at
        gap = F.when(fresh, F.substring(text, a.at + 1, s.start - a.at)).otherwise("")
        mask = F.when(fresh, F.element_at(masks, s["rank"] + 1)).otherwise("")
        return F.struct(F.greatest(a.at, s.stop).alias("at"), F.concat(a.parts, F.array(F.concat(gap, mask))).alias("parts"))

    done = F.aggregate("spans", start, step, lambda a: F.concat(F.array_join(a.parts, ""), F.substring(text, a.at + 1, F.length(text))))
    masked = F.when(F.col("spans").isNotNull(), done).otherwise(text)
    return reading(held.select(F.col("row").withField("text", masked).alias("row")).select("row.*"), found)
