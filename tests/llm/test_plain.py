"""Scores, posteriors and choices of bins against plain second implementations; empty tables and very long texts."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayworks.llm import packing, quality, sharding, toxicity, warc

DOCS = "doc_id long, text string"


def plain_fit(sizes, cap):
    """Best fit by looking at every bin ever opened, with shares of capacities as fractions."""
    most = (cap.tokens, cap.documents or cap.tokens, cap.attention or cap.tokens**2)
    bins, out = [], []
    for size in sizes:
        need = (size, 1, size * size)
        best = None
        for i, left in enumerate(bins):
            if size < cap.tokens and all(x >= y for x, y in zip(left, need, strict=True)):
                if cap.rule == "dot":
                    score = sum(w * (x / m) * (y / m) for w, x, y, m in zip(cap.weights, left, need, most, strict=True))
                else:
                    score = sum(w * ((x - y) / m) ** 2 for w, x, y, m in zip(cap.weights, left, need, most, strict=True))
                if best is None or score < best[0] - 1e-12:
                    best = (score, i)
        if best is None:
            bins.append(list(most))
            best = (0, len(bins) - 1)
        i = best[1]
        out.append((i, most[0] - bins[i][0]))
        bins[i] = [x - y for x, y in zip(bins[i], need, strict=True)]
    return out


@pytest.mark.parametrize("cap", [packing.WEIGHED, packing.Capacity(1000, 5, 400_000, (1.0, 0.3, 0.6)), packing.Capacity(1000, 4, 600_000, (1.0, 0.5, 0.2), "dot")])
def test_bins_are_the_best_of_all(cap):
    rng = np.random.default_rng(4)
    sizes = np.sort(np.concatenate([rng.integers(1, 600, 500), rng.integers(1, 20, 300)]))[::-1]
    bins, offsets, _ = packing.best_fit(sizes, cap)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == plain_fit(sizes.tolist(), cap)


def plain_quality(rows, odds, base):
    """``quality`` by doc id: sums over lists in place of aggregations."""
    p = {i: 1 / (1 + math.exp(-odds[i])) for i, _, _ in rows}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, h, s in rows:
        hosts[h].append(p[i])
        paths[h, s].append(p[i])
    every = [x for v in hosts.values() for x in v]
    mu = sum(every) / len(every)
    within = sum(x * x for x in every) / len(every) - mu * mu
    strength = lambda m, b: max(1.0, min(1e6, m * (1 - m) / max(b, 1e-9) - 1))
    mean = lambda v: sum(v) / len(v)
    k0 = strength(mu, sum(len(v) * (mean(v) - mu) ** 2 - within for v in hosts.values()) / len(every))
    prior = {h: (sum(v) + k0 * mu) / (len(v) + k0) for h, v in hosts.items()}
    k1 = strength(mu, sum(len(v) * (mean(v) - mean(hosts[h])) ** 2 - within for (h, _), v in paths.items()) / len(every))
    out = {}
    for i, h, s in rows:
        v = paths[h, s]
        site = min(max((sum(v) - p[i] + k1 * prior[h]) / (len(v) - 1 + k1), 1e-6), 1 - 1e-6)
        out[i] = 1 / (1 + math.exp(-(odds[i] - base + math.log(site / (1 - site)))))
    return out


def test_quality_against_lists(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(240):
        good = rng.random() < (0.9 if i % 4 else 0.3)
        text = " ".join(word() if good else word().upper() + "$$" for _ in range(rng.randint(5, 40)))
        rows.append((i, text, f"h{i % 4}" if i % 50 else None, f"p{i % 6 % 5}", int(good)))
    df = spark.createDataFrame(rows, f"{DOCS}, h string, p string, quality int")
    docs, labels = df.drop("quality"), df.where("doc_id % 3 = 0").select("doc_id", "quality")
    model = quality.learn(docs, labels, quality.Settings())
    import pyarrow as pa

    odds = dict(zip((r[0] for r in rows), model.log_odds(quality.features(pa.array([r[1] for r in rows]))).tolist(), strict=True))
    want = plain_quality([(r[0], r[2], r[3]) for r in rows], odds, model.base)
    got = {r["doc_id"]: r for r in quality.scored(docs, labels, F.col("h"), F.col("p")).collect()}
    assert all(math.isclose(got[i]["quality"], want[i], rel_tol=1e-6, abs_tol=1e-9) and got[i]["keep"] == (want[i] >= 0.5) for i in want)


def test_toxicity_score_against_every_token(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(120)]
    bad = ["grobnash", "fulminok", "zzarvik"]
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(words) for _ in range(rng.randint(3, 30))]
        toxic = i % 5 == 1
        if toxic:
            b = rng.choice(bad)
            w.insert(rng.randrange(len(w)), rng.choice([b, b.upper(), b.replace("o", "0").replace("i", "1"), " ".join(b), b[:2] + b[2] * 3 + b[3:]]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    channel, training = toxicity.Channel(), toxicity.Training()
    model = toxicity.log_model(toxicity.letter_counts(docs))
    bounds = {r["e"]: r["bound"] for r in toxicity.train(docs, known, model, training, channel).collect()}
    restorer = toxicity.Restorer(model, channel)
    got = {r["doc_id"]: r for r in toxicity.score(docs, known).collect()}
    assert bounds and len(got) == len(rows)
    for i, text in rows:
        rest, top = 1.0, toxicity.FLOOR
        for t in toxicity.tokens(text, restorer):  # each token, each reading of it, each piece of evidence
            b = max((bounds.get(e, 0.0) for w in restorer.words(t) if len(w) > 2 for e in toxicity.evidence(w)), default=0.0)
            rest, top = (rest * (1 - b), top) if b >= 0.5 else (rest, max(top, b))
        want = max(top, 1 - rest)
        assert math.isclose(got[i]["score"], want, abs_tol=1e-9) and got[i]["predicted"] == (want >= 0.5), text
    assert toxicity.score(docs.where("false"), known).count() == 0 and toxicity.score(docs, known.where("false")).where("predicted = 1").count() == 0


def test_empty_tables_and_long_rows(spark, tmp_path):
    import corpus_pipeline

    empty = spark.createDataFrame([], DOCS)
    shards = [f"s{k}" for k in range(3)]
    assert sharding.place(empty, "doc_id", shards, 101).count() == 0
    long = spark.createDataFrame([(1, "x" * 3_000_000), (2, None)], "id long, key string")
    placed = {r["id"]: r["shard"] for r in sharding.place(long, "key", shards, 101).collect()}
    assert set(placed) == {1, 2} and all(s in shards for s in placed.values())
    pages = spark.createDataFrame([(1, "u", "long é " * 1_500_000), (2, "v" * 100_000, "")], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in warc.read_archives(spark, warc.write_archives(pages)).collect()}
    assert found[1]["payload_bytes"] == len("long é ".encode()) * 1_500_000 and found[2]["payload_bytes"] == 0
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, schema in {"documents": None, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}.items():
        (docs if schema is None else spark.createDataFrame([], schema)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
