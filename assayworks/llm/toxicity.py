"""Toxicity of whole texts, after deobfuscation as a noisy channel.

1. A trigram language model of letters is counted over all texts.
2. A token that looks disguised (a sign of ``LEET`` or marks in it, a letter three
   times in a row) becomes a lattice of letters; Viterbi decoding under the model,
   with channel costs for substitution and deletion, restores the likeliest word.  It
   is exact: no path is pruned.  Tokens of any length are decoded as a whole and in
   their parts between marks that stand for no letter.
   Signs at the ends may be letters or marks, so both readings count.
   Runs of fragments of up to ``Channel.fragment`` signs, set apart by any white space
   or marks, are a lattice with gaps, each inside a word or between words: decoding
   joins fragments and parts words.  Longer fragments are never joined.
3. Evidence are words and their first 4, 5 and 6 letters, as written and as
   restored.  From labelled training rows each gets the lower bound (``z`` standard
   deviations) of its share of toxic documents.  A text's score joins bounds of
   at least a half as independent causes; below, it is the largest bound.

Training takes at most about ``most_labels`` labelled rows (picked by a hash of the
id); all else covers all rows.  Of an id's conflicting labels the larger counts.  Every piece of evidence whose bound tells anything is
kept: up to ``most_broadcast`` pieces go to the executors as a whole, more are joined
with the distinct tokens of the texts by shuffle.
Rows with ``crc32(doc_id as text) mod 5 = 0`` never train.

Defined cases: a null, empty or wordless text scores as no evidence does (a small
constant).  Labels other than 0 and 1, and null ids, train nothing; a null id counts
as not held out.  Repeated rows each get a score.  Without labels every score is that constant.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text, forget, reading, release, tidy, written

#: What letters a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c", "µ": "u",
}
_SIGNS = "".join(re.escape(c) for c in LEET)
_LETTER = r"[^\W\d_]"
_TRIPLE = re.compile(r"(.)\1\1")
#: Runs of a sign, and the same with letters in a row as one.
_EACH, _CHUNKS = re.compile(r"(.)\1*", re.S), re.compile(r"[^\W\d_]+|(.)\1*", re.S)
_BEFORE = (re.compile(r"^\W+"), re.compile(rf"^(?:(?![{_SIGNS}])\W)+"))
_AFTER = (re.compile(r"(?:(\W)\1{2,}|[.,;:?!\"'()\[\]{}…»«])+$"), re.compile(rf"(?:(?![{_SIGNS}])\W)+$"))
_MARKS = re.compile(rf"(?:(?![{_SIGNS}])[\W_])+")
_SINGLES = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
_LEET = re.compile(f"[{_SIGNS}]")


@dataclass(frozen=True)
class Channel:
    substitute: float = -1.0
    shorten: float = -0.5
    drop: float = -14.0
    #: A gap inside a word; a gap between words costs what the model says.
    gap: float = -0.5
    #: Letters set apart one by one are read at each of these costs; the words of all readings count.
    single_gaps: tuple[float, ...] = (0.5, 0.0, -0.5, -1.0, -1.5, -2.0, -3.0)
    #: Fragments of so many signs may be parts of a word set apart.
    fragment: int = 4


@dataclass(frozen=True)
class Training:
    z: float = 2.3
    most_labels: int = 50_000
    #: Pieces of evidence that may be collected and sent to the executors; more are joined.
    most_broadcast: int = 200_000
    least_toxic: int = 4
    #: A beginning (not a whole word) counts as a cause only from this share of toxic documents.
    least_share: float = 0.9


def _folding() -> np.ndarray:
    """Code points to 0 (no letter) or 1 to 26; accents of Latin letters fall away."""
    table = np.zeros(0x250, np.int64)
    for c in range(0x250):
        base = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        if "a" <= base <= "z":
            table[c] = ord(base) - 96
    return table


_FOLD = _folding()
_CODES = _FOLD.tolist()
_PADDED = np.append(_FOLD, 0)
#: Of the Unicode planes with letters: what may be part of a fragment (1), and what of that is a letter (2).
_PLANES = 0x20000
_KIND = np.zeros(_PLANES + 1, np.uint8)
for _m in re.finditer(r"\w", "".join(map(chr, range(_PLANES))).replace("_", " ")):
    _KIND[_m.start()] = 2 if _m[0].isalpha() else 1
_KIND[[ord(c) for c in LEET if not c.isalnum()]] = 1


def _folded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _FOLD[np.where(points < len(_FOLD), points, 0)]


def letter_counts(texts: DataFrame) -> np.ndarray:
    """Counts of letter trigrams (0 is what stands between words) over all texts, 27 x 27 x 27."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, np.int64)
        for batch in batches:
            some: list[str] = []
            size = 0
            for value in batch.column(0):
                some.append(value.as_py() or "")
                size += len(some[-1])
                if size > 1 << 19:
                    total += _trigrams("  ".join(some))
                    some, size = [], 0
            total += _trigrams("  ".join(some))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["k", "n"])

    counted = written(texts.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "letters")
    out = np.zeros(27**3)
    for r in counted.collect():  # at most 27**3 rows
        out[r["k"]] = r["n"]
    forget(counted)
    return out.reshape(27, 27, 27)


def _trigrams(text: str) -> np.ndarray:
    c = np.concatenate(([0, 0], _folded(text), [0, 0]))
    return np.bincount(c[:-2] * 729 + c[1:-1] * 27 + c[2:], minlength=27**3)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Interpolated log probabilities of a letter after two others."""
    one = counts.sum(axis=(0, 1)) + 1
    two = counts.sum(axis=0)
    p1 = one / one.sum()
    p2 = (two + 27 * p1) / (two.sum(axis=1, keepdims=True) + 27)
    p3 = (counts + 27 * p2) / (counts.sum(axis=2, keepdims=True) + 27)
    return np.log(p3)


class _Gaps(dict):
    """What is settled about gaps, by the letters around them; bounded."""

    def __init__(self, settle):
        super().__init__()
        self.settle = settle

    def __missing__(self, key: str) -> bool | None:
        if len(self) > 300_000:
            self.clear()
        self[key] = found = self.settle(key)
        return found


class Restorer:
    """Viterbi decoding of disguised tokens."""

    def __init__(self, model: np.ndarray, channel: Channel | None = None):
        self.model, self.channel = model.ravel(), channel or Channel()
        self.logs = self.model.tolist()
        self.gaps = _Gaps(self._gap)
        self.parts: dict[str, str] = {}
        self.segments: dict[str, tuple[str, ...]] = {}

    def lattice(self, token: str, gap: float | None = None) -> list[list[tuple[str, float]]]:
        """For each run of a sign: what it may be, and the cost."""
        c = self.channel
        out = []
        for m in (_EACH if _TRIPLE.search(token) else _CHUNKS).finditer(token):
            sign = m[1]
            if sign is None:  # letters in a row, none three times
                out.append([(m[0], 0.0)])
                continue
            n = len(m[0])
            if sign.isalpha():
                out.append([(sign * n, 0.0)] if n < 3 else [(sign, c.shorten), (sign * 2, c.shorten)])
            elif sign == " ":
                out.append([(" ", 0.0), ("", c.gap if gap is None else gap)])
            elif sign in LEET:
                options = [(x * k, c.substitute * k) for x in LEET[sign] for k in ((n,) if n < 3 else (1, 2))]
                out.append([*options, ("", c.drop * min(n, 2))])
            else:
                out.append([("", 0.0)])
        return out

    def decode(self, token: str, gap: float | None = None) -> str:
        logs = self.logs
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in self.lattice(token, gap):
            if len(options) == 1 and len(best) == 1:  # one path: what it costs doesn't matter
                letters = options[0][0]
                if letters:
                    ((state, (p, word)),) = best.items()
                    x, y = (*state, *(_CODES[k] if k < len(_CODES) else 0 for k in map(ord, letters[-2:])))[-2:]
                    best = {(x, y): (p, (word, letters))}
                continue
            step: dict[tuple[int, int], tuple[float, tuple]] = {}
            for letters, cost in options:
                codes = [_CODES[x] if x < len(_CODES) else 0 for x in map(ord, letters)]
                for (a, b), (p, word) in best.items():
                    x, y, q = a, b, p + cost
                    for k in codes:
                        q += logs[x * 729 + y * 27 + k]
                        x, y = y, k
                    if (x, y) not in step or q > step[x, y][0]:
                        step[x, y] = (q, (word, letters) if letters else word)
            best = step
        _, word = max(((p + self.logs[a * 729 + b * 27], w) for (a, b), (p, w) in best.items()), key=lambda x: x[0])
        parts = []
        while word:  # a chain of letters, the last first: time stays linear in the token
            word, letters = word
            parts.append(letters)
        return "".join(reversed(parts))

    def words(self, token: str) -> list[str]:
        """A lower-case token as it is, and restored if it looks disguised."""
        if token.isalpha() and "µ" not in token and not _TRIPLE.search(token):
            return [token]
        bare = _AFTER[0].sub("", _BEFORE[0].sub("", token))
        if bare.isalpha() and not _TRIPLE.search(bare) and not _LEET.search(token):
            return [bare]
        out = [bare] if bare.isalpha() else [w for w in re.findall(rf"{_LETTER}+", bare) if len(w) > 2]
        forms = {b.sub("", a.sub("", token)) for a in _BEFORE for b in _AFTER}  # signs at the ends as marks, and as letters
        tried = dict.fromkeys([*sorted(forms), *(p for f in sorted(forms) for p in _MARKS.split(f))])
        for form in tried:
            if len(form) > 2 and (not form.isalpha() or _TRIPLE.search(form)):
                word = self.decode(form)
                if len(word) > 2:
                    out.append(word)
        return list(dict.fromkeys(out))


    def _gap(self, key: str) -> bool | None:
        """Whether a gap lies inside a word, if the two letters on either side decide it; else None."""
        before, after = key.split(" ")
        if len(before) < 2 or len(after) < 2 or not (before + after).isalpha() or before[0] == before[1] or after[0] == after[1]:
            return None
        a, b, x, y = (_CODES[k] if k < len(_CODES) else 0 for k in map(ord, before + after))
        p = self.logs
        inside = self.channel.gap + p[a * 729 + b * 27 + x] + p[b * 729 + x * 27 + y]
        return inside > p[a * 729 + b * 27] + p[b * 729 + x] + p[x * 27 + y]

    def joined(self, fragments: list[str]) -> list[str]:
        """Words of a run of short fragments, gaps inside or between words as Viterbi decoding says; none if all stay apart.

        After two plain letters all paths meet, so a gap with two on either side is settled
        by itself, and only what lies between such gaps is decoded.
        """
        gaps = self.gaps
        settled = [gaps[f[-2:] + " " + g[:2]] for f, g in pairwise(fragments)]
        if True not in settled and None not in settled:
            return []
        out, at = [fragments[0]], 0
        for i, x in enumerate([*settled, False]):
            if x is None:
                continue
            if i > at:  # the gaps from fragment at to fragment i are open
                first, last = out.pop(), fragments[i]
                head = fragments[at]
                lead = head[:-2] if len(head) > 2 and head.isalpha() and head[-1] != head[-2] != head[-3] else ""
                rest = last[2:] if len(last) > 2 and last.isalpha() and last[0] != last[1] != last[2] else ""
                part = " ".join([head[len(lead) :], *fragments[at + 1 : i], last[: len(last) - len(rest)]])
                if part not in self.parts:
                    if len(self.parts) > 100_000:
                        self.parts.clear()
                    self.parts[part] = self.decode(part)
                out += (first[: len(first) - len(head)] + lead + self.parts[part] + rest).split()
            if i + 1 < len(fragments):
                if x and out:
                    out[-1] += fragments[i + 1]
                else:
                    out.append(fragments[i + 1])
            at = i + 1
        return out


def evidence(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in (4, 5, 6) if len(word) >= k)]


def tokens(text: str, restorer: Restorer) -> set[str]:
    """Distinct tokens of a text; what runs of short fragments give is put together, as tokens of their own."""
    return _read(text, restorer)[0]


def _read(text: str, restorer: Restorer) -> tuple[set[str], bool]:
    """The tokens, and whether letters alone can be no disguise: none comes three times in a row, none is a sign."""
    low = text.lower()
    out = set(low.split())
    low = low.replace("_", " ")
    plain = _put_together(low, restorer, out)
    if "|" in low or "+" in low:  # letters, or marks between fragments
        plain &= _put_together(low.replace("|", " ").replace("+", " "), restorer, out)
    return out, plain and "µ" not in low


def _put_together(low: str, restorer: Restorer, out: set[str]) -> bool:
    known = restorer.segments
    words, segments, plain = _segments(low, restorer)
    out.update(words)
    for segment in segments:
        words = known.get(segment)
        if words is None:
            words = _of_run(segment.split(), restorer)
            if len(segment) <= 100 and len(known) < 200_000:  # what prose repeats is short, and comes early
                known[segment] = words
        if words:
            out.update(words)
    return plain


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true begin, and where they are over."""
    padded = np.zeros(len(flags) + 2, bool)
    padded[1:-1] = flags
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


def _segments(low: str, restorer: Restorer) -> tuple[list[str], list[str], bool]:
    """Short fragments in a row, cut at gaps that surely part words.

    Those whose gaps are all surely inside a word are put together; of the others the
    fragments, single blanks between them.  Lastly whether no letter comes three times in a row.
    """
    points = np.frombuffer(low.encode("utf-32-le"), np.uint32)
    kind = _KIND[np.minimum(points, _PLANES)]
    twice = (points[1:] == points[:-1]) & (kind[1:] == 2)
    plain = not (twice[1:] & twice[:-1]).any()
    begins, ends = _runs(kind > 0)
    short = ends - begins <= restorer.channel.fragment
    open_ = short[:-1] & short[1:]
    at = np.flatnonzero(open_)
    if not len(at):
        return [], [], plain
    # the two signs on either side of a gap, as Restorer._gap sees them; a fragment of one sign decides nothing
    b, x = ends[at] - 1, begins[at + 1]
    a, y = np.maximum(b - 1, 0), np.minimum(x + 1, len(points) - 1)
    sure = (ends[at] - begins[at] > 1) & (ends[at + 1] - x > 1) & (kind[a] == 2) & (kind[b] == 2) & (kind[x] == 2) & (kind[y] == 2)
    sure &= (points[a] != points[b]) & (points[x] != points[y])
    ca, cb, cx, cy = (_PADDED[np.minimum(points[k], len(_FOLD))] for k in (a, b, x, y))
    p = restorer.model
    inside = restorer.channel.gap + p[ca * 729 + cb * 27 + cx] + p[cb * 729 + cx * 27 + cy]
    parted = inside <= p[ca * 729 + cb * 27] + p[cb * 729 + cx] + p[cx * 27 + cy]
    open_[at[sure & parted]] = False
    first, last = _runs(open_)
    settled = np.zeros(len(open_) + 1, np.int64)
    settled[at + 1] = ~sure
    settled = np.cumsum(settled)
    ready = settled[last] == settled[first]
    words, segments = [], []
    begins, ends = begins.tolist(), ends.tolist()
    for i, j, whole in zip(first.tolist(), last.tolist(), ready.tolist(), strict=True):
        if j == i + 1:
            f, g = low[begins[i] : ends[i]], low[begins[j] : ends[j]]
            words.append(f + g) if whole else segments.append(f"{f} {g}")
        else:
            parts = [low[begins[k] : ends[k]] for k in range(i, j + 1)]
            words.append("".join(parts)) if whole else segments.append(" ".join(parts))
    return words, segments, plain


#: Marks at the end of a token that stand for no letter.
_ENDS = ".,;:?\"')]}…»«"


def _bare(token: str, plain: bool) -> str | None:
    """The word of a token that can be no disguise, marks at its end aside."""
    word = token if token.isalpha() else token.rstrip(_ENDS)
    return word if word.isalpha() and (plain or not ("µ" in word or _TRIPLE.search(word))) else None


def _of_run(run: list[str], restorer: Restorer) -> tuple[str, ...]:
    """What the fragments of a run give, put together."""
    out = set(restorer.joined(run))
    if len(run) > 2:
        for s in _SINGLES.findall(" ".join(run)):
            word = s.replace(" ", "")
            out.update(w for gap in restorer.channel.single_gaps for w in restorer.decode(s, gap).split())
            out.update((word, word[1:], word[:-1]) if len(word) > 4 else (word,))  # a word of one letter may stand beside it
    return tuple(out)


class Lexicon:
    """Evidence with numbers, by its first four letters: most words need one look."""

    def __init__(self, bounds: dict[str, float]):
        #: What the four letters have themselves, and longer pieces and whole words that begin so.
        self.of: dict[str, tuple[float, dict[str, float] | None]] = {}
        for e, b in bounds.items():
            word = e.removeprefix("=")
            own, longer = self.of.get(word[:4], (0.0, None))
            if e is word and len(word) == 4:
                own = b
            else:
                longer = longer or {}
                longer[e] = b
            self.of[word[:4]] = own, longer

    def best(self, word: str) -> float:
        """The largest number of a word's evidence, or 0."""
        found = self.of.get(word[:4])
        if found is None:
            return 0.0
        own, longer = found
        if longer is None:
            return own if len(word) > 3 else 0.0
        get = longer.get
        return max(own if len(word) > 3 else 0.0, get(word[:5], 0.0), get(word[:6], 0.0), get("=" + word, 0.0))


def _evidence_of(text: str, restorer: Restorer, kept: dict[str, tuple], among: frozenset[str] | None, heads: frozenset[str]) -> set[str]:
    """Distinct pieces of evidence of a text, or just those of ``among``, whose first four letters are ``heads``."""
    out: set[str] = set()
    found, plain = _read(text, restorer)
    get = kept.get
    for t in found:
        e = get(t)
        if e is None:
            word = _bare(t, plain)
            if word is None:
                e = tuple(x for w in restorer.words(t) if len(w) > 2 for x in evidence(w) if among is None or x in among)
            elif len(word) < 3 or (among is not None and word[:4] not in heads):
                e = ()
            else:
                e = tuple(x for x in evidence(word) if among is None or x in among)
            if len(kept) < 200_000:  # what is frequent comes early
                kept[t] = e
        if e:
            out.update(e)
    return out


def _counted(rows: DataFrame, model: np.ndarray, channel: Channel, only: list[str] | None) -> DataFrame:
    """In how many of the texts each piece of evidence occurs, or just those of ``only``."""
    sent = rows.sparkSession.sparkContext.broadcast((model, only))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, only = sent.value
        restorer, kept, seen = Restorer(model, channel), {}, Counter()
        among = frozenset(only) if only is not None else None
        heads = frozenset(e.removeprefix("=")[:4] for e in only or ())

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["e", "n"])

        for batch in batches:
            for value in batch.column(0):
                seen.update(_evidence_of(value.as_py() or "", restorer, kept, among, heads))
                if len(seen) > 300_000:
                    yield out()
                    seen.clear()
        yield out()
        del restorer, kept
        seen.clear()
        tidy()

    return rows.select("text").mapInArrow(run, "e string, n long").groupBy("e").agg(F.sum("n").alias("n"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, t: Training, channel: Channel) -> DataFrame:
    """``e, bound``: the lower bound of the toxic share for each piece of evidence worth keeping."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > t.most_labels:
        share = int(t.most_labels / n * (1 << 20))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    rows = docs.join(F.broadcast(known), "doc_id")  # no more than about most_labels rows
    bad = written(_counted(rows.where("toxic = 1"), model, channel, None).where(F.col("n") >= t.least_toxic), "toxic")
    few = bad.count() <= t.most_broadcast
    among = [r["e"] for r in bad.select("e").collect()] if few else None  # spares rows, changes no count
    good = _counted(rows.where("toxic = 0"), model, channel, among).withColumnRenamed("n", "clean")
    m, zz = F.col("n") + F.coalesce("clean", F.lit(0)), t.z**2
    p = F.col("n") / m
    bound = (p + zz / (2 * m) - t.z * F.sqrt(p * (1 - p) / m + zz / (4 * m * m))) / (1 + zz / m)
    beginning = (p < t.least_share) & ~F.startswith("e", F.lit("="))
    bound = F.when(beginning, F.least(bound, F.lit(0.49))).otherwise(bound)
    out = written(bad.join(good, "e", "left").select("e", bound.alias("bound")).where("bound > 0.1"), "bounds")
    forget(bad)
    return out


#: The score of a text without evidence.
FLOOR = 0.02


def score_text(text: str, restorer: Restorer, lexicon: Lexicon, kept: dict[str, float]) -> float:
    """Join the best bound of each token; restored words of one and two letters are no evidence."""
    rest, top = 1.0, FLOOR
    found, plain = _read(text, restorer)
    get, head, best = kept.get, lexicon.of.get, lexicon.best
    for t in found:
        if plain and t.isalpha():  # most tokens; the same as best(t), which costs less than to remember it
            f = head(t[:4])
            if f is None:
                continue
            b, longer = f
            if longer is not None:
                b = max(b, longer.get(t[:5], 0.0), longer.get(t[:6], 0.0), longer.get("=" + t, 0.0))
        else:
            b = get(t)
            if b is None:
                word = _bare(t, plain)
                b = max((best(w) for w in ((word,) if word else restorer.words(t)) if len(w) > 2), default=0.0)
                if len(kept) < 300_000:  # what is frequent comes early
                    kept[t] = b
        if b >= 0.5:
            rest *= 1 - b
        elif b > top:
            top = b
    return max(top, 1 - rest)


def score(docs: DataFrame, labels: DataFrame, training: Training | None = None, channel: Channel | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs(doc_id, text)``; learns from ``labels(doc_id, toxic)``."""
    t, c = training or Training(), channel or Channel()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_text(F.col("text")).alias("text"))
    model = log_model(letter_counts(docs))
    bounds = train(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), model, t, c)
    few = bounds.count() <= t.most_broadcast
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    found = _looked_up(marked, {r["e"]: r["bound"] for r in bounds.collect()}, model, c) if few else _joined(marked, bounds, model, c)
    out = written(found, "scores", few=False)
    release(found)
    forget(bounds)
    return reading(out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), out)


def _looked_up(docs: DataFrame, bounds: dict[str, float], model: np.ndarray, channel: Channel) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((model, bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bounds = sent.value
        restorer, lexicon, kept = Restorer(model, channel), Lexicon(bounds), {}
        for batch in batches:
            scores = [score_text(x.as_py(), restorer, lexicon, kept) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])
        del restorer, lexicon, kept
        tidy()

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double")


def _joined(docs: DataFrame, bounds: DataFrame, model: np.ndarray, channel: Channel) -> DataFrame:
    """The same scores by joins: distinct tokens of each text, the best bound of each token, the bounds of a text."""
    key = [F.xxhash64("text").alias("_h"), F.xxhash64(F.reverse("text"), F.length("text")).alias("_g")]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model, channel)
        for batch in batches:
            for h, g, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = list(tokens(text, restorer))
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(found), pa.int64()) for x in (h, g)] + [pa.array(found, pa.string())], names=["_h", "_g", "t"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model, channel)
        for batch in batches:
            rows = [(t, e) for t in batch.column(0).to_pylist() for e in {e for w in restorer.words(t) if len(w) > 2 for e in evidence(w)}]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["t", "e"])

    held = written(docs.select(*key, "text").mapInArrow(split, "_h long, _g long, t string").distinct(), "tokens")
    best = held.select("t").distinct().mapInArrow(pieces, "t string, e string").join(bounds, "e").groupBy("t").agg(F.max("bound").alias("b"))
    best = written(best, "best")  # a plain table: the join with a very frequent token is split by AQE
    strong = F.col("b") >= 0.5
    of_text = held.join(best, "t").groupBy("_h", "_g").agg(
        F.coalesce(F.sum(F.when(strong, F.log1p(-F.col("b")))), F.lit(0.0)).alias("rest"), F.coalesce(F.max(F.when(~strong, F.col("b"))), F.lit(0.0)).alias("top")
    )
    whole = F.greatest(F.lit(FLOOR), F.coalesce("top", F.lit(0.0)), -F.expm1(F.coalesce("rest", F.lit(0.0))))
    of_text = written(of_text, "texts")
    forget(best)
    out = docs.select("doc_id", "held_out", *key).join(of_text, ["_h", "_g"], "left").select("doc_id", "held_out", whole.alias("score"))
    return reading(out, held, of_text)
