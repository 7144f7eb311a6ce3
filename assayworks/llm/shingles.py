"""Word shingles and MinHash signatures, straight from Arrow string buffers.

No Python string is made for a text: word hashes come from prefix sums of a
polynomial over the UTF-8 bytes, shingle hashes from five word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
#: Bytes of text hashed at a time; one longer text is hashed in pieces of about that, cut at white space.
CHUNK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeds(n: int, start: int) -> np.ndarray:
    return mix(np.arange(start, start + n, dtype=np.uint64) * _GOLD + np.uint64(start))


_BYTE = seeds(256, 1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_POS = seeds(64, 1000) | np.uint64(1)
_pow: dict[str, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _pow.get(key)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        have = np.empty(size, np.uint64)
        have[0] = 1
        done, step = 1, base
        while done < size:  # doubling: p[done:2*done] = p[:done] * base**done
            more = min(done, size - done)
            have[done : done + more] = have[:more] * np.uint64(step)
            done, step = done + more, step * step % (1 << 64)
        _pow[key] = have
    return have[:n]


def _chunks(offsets: np.ndarray):
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def shingle_sets(column: pa.Array, width: int = 5):
    """Yield ``(first, sets)`` over chunks: the sorted distinct shingle hashes of each text.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A
    text of fewer than ``width`` words, but not none, has one shingle, its whole
    sequence.
    """
    raw, off = text_buffer(column)
    for first, last in _chunks(off):
        lo, hi = int(off[first]), int(off[last])
        if last - first == 1 and hi - lo > CHUNK:
            hashed = np.concatenate([_words(raw[a:b], np.array([0, b - a]))[1] for a, b in _pieces(raw, lo, hi)])
            at = np.array([0, len(hashed)])
        else:
            marks = off[first : last + 1] - lo
            starts, hashed = _words(raw[lo:hi], marks)
            at = np.searchsorted(starts, marks)
        yield first, _sets(hashed, at, width)


def _pieces(raw: np.ndarray, lo: int, hi: int):
    """Parts of a text of about ``CHUNK`` bytes that end before white space; one longer word stays whole."""
    while lo < hi:
        end = lo + CHUNK
        while end < hi:
            white = np.flatnonzero(_WHITE[raw[end : min(hi, end + CHUNK)]])
            if len(white):
                end += int(white[0])
                break
            end += CHUNK
        end = min(end, hi)
        yield lo, end
        lo = end


def _words(part: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and their hashes, in texts that begin at ``marks``."""
    n = len(part)
    none = np.zeros(0, np.uint64)
    if not n:
        return np.zeros(0, np.int64), none
    word = ~_WHITE[part]
    edge = np.zeros(n + 1, bool)
    edge[marks] = True
    starts = np.flatnonzero(word & (edge[:n] | np.concatenate(([True], ~word[:-1]))))
    if not len(starts):
        return starts, none
    ends = np.flatnonzero(word & (edge[1:] | np.concatenate((~word[1:], [True])))) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[part] * _powers(_BASE, n), out=total[1:])
    return starts, mix((total[ends] - total[starts]) * _powers(_BACK, n)[starts] + (ends - starts).astype(np.uint64))


def _sets(hashed: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """The shingle sets of texts whose words are ``hashed[at[d]:at[d + 1]]``."""
    empty = np.zeros(0, np.uint64)
    if len(hashed) >= width:
        m = len(hashed) - width + 1
        joined = np.zeros(m, np.uint64)
        for k in range(width):
            joined += hashed[k : k + m] * _POS[k]
        joined = mix(joined)
    else:
        joined = empty
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(joined[a : b - width + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            whole = (hashed[a:b] * _POS[: b - a]).sum(keepdims=True) + np.array([b - a], np.uint64) * _GOLD
            out.append(mix(whole))
        else:
            out.append(empty)
    return out


class Signer:
    """MinHash minima, their band keys and their packed low bits."""

    def __init__(self, bands: int, rows: int, bits: int, seed: int = 7):
        self.bands, self.rows, self.bits = bands, rows, bits
        k = bands * rows
        self.mul = seeds(k, 5000 + seed) | np.uint64(1)
        self.add = seeds(k, 90000 + seed)
        self.band_salt = seeds(bands, 700000 + seed)
        self.row_mul = seeds(rows, 800000 + seed) | np.uint64(1)

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row for each set; no set may be empty."""
        flat = np.concatenate(sets)
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
        out = np.empty((len(sets), len(self.mul)), np.uint64)
        for k in range(len(self.mul)):
            out[:, k] = np.minimum.reduceat(flat * self.mul[k] + self.add[k], at)
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        cube = minima.reshape(len(minima), self.bands, self.rows)
        return mix((mix(cube) * self.row_mul).sum(axis=2, dtype=np.uint64) + self.band_salt).view(np.int64)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        """The lowest ``bits`` bits of each (mixed) minimum, packed to bytes."""
        low = mix(minima) & np.uint64((1 << self.bits) - 1)
        planes = ((low[:, :, None] >> np.arange(self.bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        return np.packbits(planes.reshape(len(minima), -1), axis=1)


def matches(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """For packed signatures (64-bit words, last axis): how many minima agree in their low bits.

    ``bits`` must divide 64: a minimum then never crosses a word.
    """
    diff = x ^ y
    step = 1
    while step < bits:  # fold the bits of a minimum onto its lowest bit
        diff = diff | (diff >> np.uint64(step))
        step *= 2
    lanes = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    return x.shape[-1] * (64 // bits) - np.bitwise_count(diff & lanes).sum(axis=-1, dtype=np.int64)


def estimate(agree: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Similarity from the share of agreeing low bits, corrected for chance collisions."""
    chance = 0.5**bits
    return (agree / k - chance) / (1 - chance)
