"""Best-fit packing of tokenised documents under several capacities at once.

A sequence (bin) has three capacities: tokens, documents and attention cost (the
sum of squared piece lengths).  Pieces come in order of decreasing length; each
goes to the open bin that can hold it in every dimension and scores best, by the
norm of the weighted residual after placement or by the weighted dot product of
residual and demand, each residual as a share of its capacity.  Of equal scores the
bin opened first takes the piece; of equal lengths the smaller id and piece come
first.  Rows are dealt into groups of about ``group_pieces`` by a hash of their
place in the written table, copies like any others; each group is packed on its
own, so a task's memory does not grow with the corpus and what groups waste is
their last few bins.

Token ids equal those of the ``tokenizers`` file given by path.  Runs between
single blanks are encoded once and kept (boundaries before a lone blank between
two non-blanks never fall inside a token of this vocabulary's pattern).

Defined cases: a null or empty text is the end id alone.  A text that holds the
name of a special token gets that token's id, as the library does by default.
Repeated rows are packed as often as they occur; a null id stays null.  Extra
columns do not come through.  An empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import reading, tidy, written

#: Fixed value: the public split pattern of this byte-level vocabulary.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Capacity:
    tokens: int = 2048
    #: None: no limit beyond what the tokens give.
    documents: int | None = None
    attention: int | None = None
    #: Weights of tokens, documents and attention cost in the choice of a bin.
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"
    group_pieces: int = 16384


#: What the query and the pipeline use: all three residuals choose the bin.  No more than 256 documents share a
#: sequence; a whole sequence of one document costs all its attention, so that limit can't be lower.
WEIGHED = Capacity(documents=256, attention=2048 * 2048, weights=(1.0, 0.25, 0.25))


#: White space besides the blank and the line feed (Unicode's, and ASCII's separators).
_OTHER_WHITE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class Encoder:
    """Text to little-endian unsigned 32-bit ids, with a bounded memory of runs.

    A run is a line feed or blank (left out of the key if a blank) and what
    follows up to the next white space.  Runs that are new in a call are encoded
    together, a line feed between them, and told apart by its id.
    """

    def __init__(self, path: str, most_kept: int = 300_000):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 up
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}
        ranks = {bytes(letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self._enc = tiktoken.Encoding("pack", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = list(special)
        self._kept: dict[str, bytes] = {}
        self._most = most_kept
        self._cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
        self._feed = ranks[b"\n"]

    def clear(self) -> None:
        """Give up the runs kept."""
        self._kept = {}

    def _encode(self, run: str) -> bytes:
        special = any(x in run for x in self._special)
        ids = self._enc.encode(run, allowed_special="all") if special else self._enc.encode_ordinary(run)
        return np.array(ids, np.uint32).tobytes()

    def _plain(self, text: str) -> bool:
        """No two white-space characters meet, none is at an end, and blanks and line feeds are the only ones."""
        return not (
            "  " in text
            or "\n\n" in text
            or " \n" in text
            or "\n " in text
            or text[0] in " \n"
            or text[-1] in " \n"
            or any(x in text for x in self._special)
            or any(c in text for c in _OTHER_WHITE)
        )

    def _learn(self, new: list[str]) -> None:
        """Encode runs that hold no line feed but as their first character."""
        blank = [r for r in new if r[0] != "\n"]
        if blank:
            ids = np.array(self._enc.encode_ordinary(" " + "\n ".join(blank)), np.uint32)
            cuts = np.flatnonzero(ids == self._feed)
            begins, ends = np.append(0, cuts + 1).tolist(), np.append(cuts, len(ids)).tolist()
            raw = ids.tobytes()
            self._kept.update(zip(blank, (raw[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)), strict=True))
        for r in new:
            if r[0] == "\n":
                self._kept[r] = self._encode(r)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        kept, split, new = self._kept, [], set()
        for text in texts:
            if text and self._plain(text):
                runs = text.replace("\n", " \n").split(" ")
                new.update(r for r in runs if r not in kept)
                split.append(runs)
            else:
                split.append(None)
        if new:
            self._learn(list(new))
        out = []
        for text, runs in zip(texts, split, strict=True):
            if runs is None:
                out.append(b"".join(map(self._encode, self._cut.split(text))))
            else:
                out.append(self._encode(runs[0]) + b"".join(map(kept.__getitem__, runs[1:])))
        if len(kept) > self._most:  # what is frequent came before
            for r in new:
                del kept[r]
        return out


def _in_parts(enc: Encoder, column: pa.Array, chars: int = 1 << 20) -> Iterator[bytes]:
    """Encode a column, about so many characters at a time."""
    some: list[str] = []
    size = 0
    for value in column:
        some.append(value.as_py() or "")
        size += len(some[-1])
        if size >= chars:
            yield from enc.encode_all(some)
            some, size = [], 0
    yield from enc.encode_all(some)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def pieces(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` to pieces of at most ``longest`` tokens, each document's ids then ``end_id``.

    Only documents of more than ``longest`` ids are cut; all their pieces but the
    first are full.  ``with_ids`` adds the ids themselves.
    """
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(tokenizer), struct.pack("<I", end_id)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), _in_parts(enc, batch.column(1)), strict=True):
                ids += tail
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = ((n - 1) % longest + 1) if at == 0 else longest
                    part = ids[4 * at : 4 * (at + size)]
                    row = (doc_id, k, at, size, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, np.int32)) if with_ids else row)
                    at, k = at + size, k + 1
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
        enc.clear()
        tidy()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kinds)


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack lengths (in their order) into bins: the bin, the offset and the number of bins' uses of each."""
    most = np.array(
        [cap.tokens, cap.documents or cap.tokens, cap.attention or cap.tokens * cap.tokens],
        np.float64,
    )
    weights = np.array(cap.weights) / most**2
    n = len(lengths)
    left = np.empty((3, max(n, 1)), np.float64)  # open bins: what is left
    name = np.empty(max(n, 1), np.int64)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    open_n = made = 0
    smallest = np.minimum.accumulate(lengths[::-1])[::-1] if n else lengths
    for i, size in enumerate(lengths):
        need = np.array([size, 1.0, float(size) * size])
        if i % 256 == 0 and open_n:  # bins that can take nothing that is still to come
            use = np.flatnonzero((left[0, :open_n] >= smallest[i]) & (left[1, :open_n] >= 1))
            left[:, : len(use)] = left[:, use]
            name[: len(use)] = name[use]
            open_n = len(use)
        room = left[:, :open_n]
        fit = np.flatnonzero((room[0] >= need[0]) & (room[1] >= need[1]) & (room[2] >= need[2])) if size < cap.tokens else ()
        if len(fit):
            there = room[:, fit]
            if cap.rule == "dot":
                b = fit[np.argmin(weights @ (there * need[:, None]))]
            else:
                b = fit[np.argmin(weights @ (there - need[:, None]) ** 2)]
        else:
            if (need > most).any():
                raise ValueError(f"a piece of {size} tokens exceeds the capacities {most.tolist()}")
            b, open_n = open_n, open_n + 1
            left[:, b] = most
            name[b] = made
            made += 1
        bins[i] = name[b]
        offsets[i] = int(most[0] - left[0, b])
        left[:, b] -= need
    return bins, offsets, np.bincount(bins, minlength=made) if n else np.zeros(0, np.int64)


def placed(cut: DataFrame, cap: Capacity | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces (``doc_id``, ``piece``, ``length`` and any other columns)."""
    cap = cap or Capacity()
    group_name = "group of " + " ".join(cut.columns)
    total = cut.count()
    groups = max(1, -(-total // cap.group_pieces))

    def run(group: pa.Table) -> pa.Table:
        length = group.column("length").to_numpy()
        order = np.lexsort([*(np.nan_to_num(group.column(c).to_numpy()) for c in ("piece", "doc_id")), -length])
        bins, offsets, _ = best_fit(length[order], cap)
        base = group.column(group_name)[0].as_py() << 32
        out = group.drop_columns([group_name]).take(pa.array(order))
        return out.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))

    dealt = cut.withColumn(group_name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return reading(dealt.groupBy(group_name).applyInArrow(run, schema + ", sequence_id long, offset long"), cut)


def pack(docs: DataFrame, tokenizer: str, cap: Capacity | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs(doc_id, text)``: a row for each piece with its sequence and offset."""
    cap = cap or Capacity()
    cut = written(pieces(docs, tokenizer, cap.tokens, end_id, with_ids), "pieces")
    return placed(cut, cap)
