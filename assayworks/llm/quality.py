"""Document quality: classifier evidence shrunk toward host and path posteriors.

1. A logistic regression on the style of whole texts (letter classes, marks,
   repetition, length) gives each document a probability and its evidence, the log
   odds less those of the base rate.  It is fitted on at most about ``most_labels``
   labelled rows, picked by a hash of the id.
2. Hierarchical empirical Bayes over all documents: a host's expected quality is
   the mean of its documents' probabilities, shrunk toward the global mean; a path's
   is shrunk toward its host's.  How strongly follows from the variance between hosts
   and between paths of a host (method of moments), so sparse sites lean on
   their priors.  These are grouped aggregations of three numbers.
3. ``quality`` adds a document's evidence to the log odds of its path's posterior,
   its own part left out of it.  Documents below ``least`` are rejected.

Texts are scored once: rows are written with their log odds, then aggregated and
joined.  Posteriors are broadcast up to ``broadcast_sites`` sites and joined by
shuffle beyond, with equal results.  :func:`host_of` and :func:`path_of` take hosts and
first path segments from URLs; any other columns may stand for them.

Defined cases: a null text is empty; null hosts and paths are sites of their own.
Labels other than 0 and 1 are ignored; of an id's conflicting labels the smaller counts.
Without labels of both kinds the evidence is 0 and everything stays.  Repeated rows
each get a score.  Columns of the input are carried through under any name; those
that the operator adds replace columns of the same name.  An empty table gives an
empty one.  A very long text takes the memory of its bytes and 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text, forget, reading, written
from assayworks.llm.shingles import shingle_sets, text_buffer


@dataclass(frozen=True)
class Settings:
    least: float = 0.5
    most_labels: int = 50_000
    ridge: float = 1.0
    broadcast_sites: int = 200_000


#: Classes of bytes: upper and lower case, digits, blanks, line ends, stops, shouts, signs, first bytes of other letters.
_CLASSES = np.zeros((256, 9))
for _k, _chars in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b"\n", b".,;:?", b"!", b"#$%&*|<>=_~^\\/{}[]@+", bytes(range(0xC0, 256)))
):
    _CLASSES[list(_chars), _k] = 1
N_FEATURES = 12
_CHUNK = 1 << 18


def _histograms(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How often each byte occurs in each text, a piece of about ``_CHUNK`` bytes at a time."""
    n = len(off) - 1
    out = np.zeros((n, 256))
    at = 0
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(off, off[at] + _CHUNK, "right")) - 1))
        if end == at + 1:  # perhaps one long text
            for lo in range(int(off[at]), int(off[end]), _CHUNK):
                out[at] += np.bincount(raw[lo : min(lo + _CHUNK, int(off[end]))], minlength=256)
        else:
            of = np.repeat(np.arange(end - at) * 256, np.diff(off[at : end + 1]))
            out[at:end] = np.bincount(of + raw[off[at] : off[end]], minlength=(end - at) * 256).reshape(-1, 256)
        at = end
    return out


def features(column: pa.Array) -> np.ndarray:
    """Style features, a row for each text."""
    raw, off = text_buffer(column)
    n = len(off) - 1
    out = np.zeros((n, N_FEATURES))
    if not n:
        return out
    size = np.diff(off)
    upper, lower, digit, blank, line, stop, shout, sign, high = (_histograms(raw, off) @ _CLASSES).T
    letters = upper + lower + high
    words = blank + 1.0
    out[:, 0] = upper / (letters + 1)
    out[:, 1] = digit / (size + 1)
    out[:, 2] = np.sqrt(sign / words)
    out[:, 3] = np.sqrt(shout / words)
    out[:, 4] = stop / words
    out[:, 5] = np.log1p(letters / words)
    out[:, 6] = np.log1p(words)
    out[:, 7] = np.log1p(words / (line + 1))
    out[:, 8] = high / (letters + 1)
    out[:, 10] = letters / (size + 1)
    for first, sets in shingle_sets(column, 2):
        for i, s in enumerate(sets, first):
            out[i, 9] = len(s) / max(1.0, np.expm1(out[i, 6]) - 1)
    out[:, 11] = out[:, 9] ** 2
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(_design(x, self.mean, self.scale) @ self.weights, -12, 12)


def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([np.ones((len(z), 1)), z, z * z])


def fit(x: np.ndarray, y: np.ndarray, ridge: float) -> Model | None:
    """Ridge logistic regression by Newton steps; none unless both labels occur."""
    if not len(y) or y.min() == y.max():
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    d = _design(x, mean, scale)
    w = np.zeros(d.shape[1])
    penalty = np.full(d.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        h = (d * (p * (1 - p))[:, None]).T @ d + np.diag(penalty)
        step = np.linalg.solve(h, d.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    rate = float(y.mean())
    return Model(mean, scale, w, float(np.log(rate / (1 - rate))))


def _styled(model: Model | None):
    """A column function: the log odds of texts."""

    def odds(texts: pa.Array) -> pa.Array:
        return pa.array(model.log_odds(features(texts)) if model else np.zeros(len(texts)), pa.float64())

    return F.arrow_udf(odds, "double")


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(found, F.lit(""))


def path_of(url: Column) -> Column:
    """The first segment of a URL's path, ``/`` if it is empty; null without a host."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]*)", 1)
    return F.when(host_of(url).isNotNull(), F.when(found == "", "/").otherwise(found))


def learn(docs: DataFrame, labels: DataFrame, s: Settings) -> Model | None:
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("y"))
    n = known.count()
    if n > s.most_labels:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(s.most_labels / n * (1 << 20)))
    rows = docs.select(F.col("doc_id").alias("id"), as_text(F.col("text")).alias("text")).join(F.broadcast(known), "id")
    style = F.arrow_udf(lambda t: pa.array(list(features(t)), pa.list_(pa.float64())), "array<double>")
    styled = written(rows.select("id", "y", style("text").alias("x")), "styled")
    found = styled.orderBy("id", "x").toArrow()  # no more than about most_labels rows
    forget(styled)
    if not found.num_rows:
        return None
    return fit(np.array(found.column("x").to_pylist()), found.column("y").to_numpy().astype(np.float64), s.ridge)


def _strength(mean: Column, between: Column) -> Column:
    """Prior observations of a beta prior with this mean and this variance between groups."""
    return F.greatest(F.lit(1.0), F.least(F.lit(1e6), mean * (1 - mean) / F.greatest(between, F.lit(1e-9)) - 1))


def posteriors(sites: DataFrame) -> DataFrame:
    """``host, path, prior, strength, total, n``: what a path's posterior is made of, its host's and the global one in it.

    ``sites(host, path, n, total, squares)`` are sums over documents.
    """
    whole = sites.agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("squares").alias("q"))
    whole = whole.select((F.col("t") / F.col("n")).alias("mu"), (F.col("q") / F.col("n") - F.pow(F.col("t") / F.col("n"), 2)).alias("within"))
    hosts = sites.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("total").alias("ht"))
    mean = F.col("ht") / F.col("hn")
    spread = hosts.join(F.broadcast(whole)).agg(
        # the variance between hosts: what is seen, less what the means of so many documents vary by themselves
        F.sum(F.col("hn") * F.pow(mean - F.col("mu"), 2) - F.col("within")).alias("b"), F.sum("hn").alias("n")
    )
    glob = whole.join(F.broadcast(spread)).select("mu", "within", _strength(F.col("mu"), F.col("b") / F.col("n")).alias("k0"))
    host = hosts.join(F.broadcast(glob)).select("host", "within", "hn", "ht", ((F.col("ht") + F.col("k0") * F.col("mu")) / (F.col("hn") + F.col("k0"))).alias("prior"))
    both = sites.join(host, sites["host"].eqNullSafe(host["host"])).drop(host["host"])
    inner = both.agg(
        F.sum(F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("ht") / F.col("hn"), 2) - F.col("within")).alias("b"),
        F.sum("n").alias("m"),
        (F.sum("total") / F.sum("n")).alias("mu1"),
    )
    k1 = inner.select(_strength(F.col("mu1"), F.col("b") / F.col("m")).alias("strength"))
    return both.join(F.broadcast(k1)).select("host", "path", "prior", "strength", "total", "n")


_ADDED = ("evidence", "host_posterior", "path_posterior", "quality", "keep")


def scored(docs: DataFrame, labels: DataFrame, host: Column, path: Column, settings: Settings | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or just its columns ``carry``) with ``evidence``, ``host_posterior``, ``path_posterior``, ``quality`` and ``keep``."""
    s = settings or Settings()
    model = learn(docs, labels, s)
    base = model.base if model else 0.0
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in _ADDED]
    row = F.struct(*[docs[f"`{c}`"] for c in names]).alias("row")
    odds = _styled(model)(as_text(F.col("text"))).alias("odds")
    rows = written(docs.select(row, host.cast("string").alias("host"), path.cast("string").alias("path"), odds), "scored")
    p = 1 / (1 + F.exp(-F.col("odds")))
    sites = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("total"), F.sum(p * p).alias("squares")), "sites")
    known = written(posteriors(sites).withColumnsRenamed({"host": "h", "path": "p"}), "posteriors")
    forget(sites)
    few = known.count() <= s.broadcast_sites
    full = rows.join(F.broadcast(known) if few else known, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    site = (F.col("total") - p + F.col("strength") * F.col("prior")) / (F.col("n") - 1 + F.col("strength"))
    site = F.least(F.greatest(site, F.lit(1e-6)), F.lit(1 - 1e-6))
    evidence = F.col("odds") - F.lit(base)
    quality = 1 / (1 + F.exp(-(evidence + F.log(site / (1 - site)))))
    keep = F.lit(True) if model is None else quality >= s.least
    values = dict(zip(_ADDED, (evidence, F.col("prior"), site, quality, keep), strict=True))
    out = full.select(*[F.col("row").getField(c).alias(c) for c in names], *[v.alias(k) for k, v in values.items()])
    return reading(out, rows, known)


def reject(docs: DataFrame, labels: DataFrame, host: Column, path: Column, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they are."""
    names = [c for c in docs.columns if c.lower() in _ADDED]
    safe = docs.withColumnsRenamed({c: f"input column {c}" for c in names})
    found = scored(safe, labels, host, path, settings)
    back = {f"input column {c}": c for c in names}
    return reading(found.where("keep").select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in safe.columns]), found)
