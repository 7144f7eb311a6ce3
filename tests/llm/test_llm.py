"""Small cases for each operator: nulls, empty and odd texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayworks.llm import decontamination, graph, licenses, minhash_dedup, packing, pii, quality, sharding, toxicity, vector_dedup, warc

DOCS = "doc_id long, text string"
RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def word_sets(rows):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    return out


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (4, 5), (5, 5), (9, 8), (8, 7), (7, 1), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 4: 4, 5: 4}
    assert graph.components(edges.where("false")).count() == 0


def test_components_refuses_to_stop_early(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        graph.components(edges, most_rounds=1)
    assert {r["component"] for r in graph.components(edges).collect()} == {0}


def test_near_duplicates_brute_force(spark):
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, "  "), (3, "one two"), (4, "ONE two"), (5, "One\ttwo three"), (5, "One\ttwo three"), (6, "é x É x")]
    base = prose(120, 1).split()
    for i in range(10, 60):  # a group of near copies around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    rows += [(i, prose(60, i)) for i in range(100, 120)] + [(200, prose(60, 100) + " tail")]
    df = spark.createDataFrame(rows, DOCS).withColumn("sig", F.lit("clash"))
    for least in (80, 85):
        got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(df, minhash_dedup.Settings(least=least, block=8)).collect()}
        sets = word_sets(rows)
        lead = {i: i for i in sets}

        def find(x, lead=lead):
            while lead[x] != x:
                x = lead[x]
            return x

        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    lead[y] = x
        assert {i: got[i]["component_id"] for i in sets} == {i: find(i) for i in sets}
        assert all(got[i]["n_shingles"] == len(sets[i]) and got[i]["kept"] == (find(i) == i) for i in sets)
    joined = minhash_dedup.drop_near_duplicates(df, minhash_dedup.Settings(broadcast_ids=0))  # by shuffle, not broadcast
    kept = minhash_dedup.drop_near_duplicates(df)
    assert sorted(r["doc_id"] for r in joined.collect()) == sorted(r["doc_id"] for r in kept.collect())
    assert kept.columns == df.columns and kept.where("doc_id = 5").count() == 1 and kept.where("doc_id = 4").count() == 0
    assert minhash_dedup.near_duplicates(df.where("false")).count() == 0


def test_quality(spark):
    good = [(i, prose(40, i), f"h{i % 3}", "p", 1) for i in range(60)]
    bad = [(i, " ".join(w.upper() + "$$$" for w in prose(40, i).split()), f"h{i % 3}", "p", 0) for i in range(60, 90)]
    odd = [(90, None, None, None, None), (91, "", "h0", "q", None), (0, good[0][1], "h0", "p", None)]
    df = spark.createDataFrame(good + bad + odd, "doc_id long, text string, source string, lang string, quality int").withColumn("keep", F.lit("clash"))
    docs, labels = df.drop("quality"), df.where("quality is not null").select("doc_id", "quality")
    got = quality.scored(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == 93 and all(r["keep"] for r in got if r["doc_id"] < 60) and not any(r["keep"] for r in got if 60 <= r["doc_id"] < 90)
    assert quality.reject(docs, labels.where("false"), F.col("source"), F.col("lang")).count() == 93
    assert quality.reject(docs.where("false"), labels, F.col("source"), F.col("lang")).count() == 0


def test_posteriors_shrink(spark):
    sites = spark.createDataFrame([("a", "x", 1000, 900.0, 850.0), ("b", "x", 1000, 100.0, 60.0), ("c", "x", 1, 0.0, 0.0)], "host string, path string, n long, total double, squares double")
    got = {r["host"]: r["prior"] for r in quality.posteriors(sites).collect()}
    assert got["a"] > 0.85 and got["b"] < 0.15 and 0 < got["c"] < 0.5


def test_warc_round_trip(spark, tmp_path):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC/1.1"
    rows = [(1, "u", "same"), (2, "u v\n", "same"), (3, None, None), (4, "", ""), (5, "u", tricky), (None, "u", "same"), (6, "é", "ü" * 10), (7, "u", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("original", F.lit(1))
    got = warc.read_archives(spark, warc.write_archives(df, file_bytes=100_000), with_payload=True).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    import base64

    for i, _, html in rows:
        body = (html or "").encode()
        assert by[i]["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode() and by[i]["payload_bytes"] == len(body)
        if by[i]["record_type"] == "response":
            assert by[i]["payload"] == body
    assert by[1]["refers_to"] == 2 and by[None]["refers_to"] == 2 and by[2]["record_type"] == "response" and by[3]["refers_to"] == 4
    assert warc.read_archives(spark, warc.write_archives(df.where("false"))).count() == 0


def test_warc_ids_and_members(spark, tmp_path):
    import gzip
    import zlib

    rows = [(-1, "u", "same"), (None, "u", "same"), (3, "v", "twice"), (3, "v", "twice"), (2, "w", "twice"), (None, None, "lone"), (None, None, "lone"), (9, "b", RNG.randbytes(18 << 20).hex())]
    path = str(tmp_path / "out")
    got = warc.read_archives(spark, warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{path}")).collect()
    told = sorted((r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in got)
    assert told == sorted([(False, -1, "response", 0), (True, 0, "revisit", -1), (False, 3, "response", 0), (False, 3, "response", 0), (False, 2, "revisit", 3),
                           (True, 0, "response", 0), (True, 0, "response", 0), (False, 9, "response", 0)])
    ids, infos = [], 0
    for file in sorted((tmp_path / "out").glob("part-*")):
        data = file.read_bytes()
        whole = gzip.decompress(data)
        ids += re.findall(rb"WARC-Record-ID: (\S+)", whole)
        infos += whole.count(b"WARC-Type: warcinfo")
        while data:  # each record can be read by itself
            one = zlib.decompressobj(31)
            first = one.decompress(data)
            assert first.startswith(b"WARC/1.1\r\n") or len(whole) > 1 << 24
            data = one.unused_data
    assert len(ids) == len(set(ids)) == len(rows) + infos and infos >= 1


TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    texts = ["", " ", "a  b\n\n c\t d", "x<|endoftext|> y", " lead", "trail ", "1234 it's we'll\nfoo\r\nbar", "ab\x1f cd", "é ü 漢字 😀", "a\n b", "a \nb", prose(300, 7), " x y"]
    for _ in range(2):
        assert [list(np.frombuffer(x, np.uint32)) for x in enc.encode_all(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark):
    rows = [(i, prose(n, i)) for i, n in enumerate([5, 900, 30, 3000, 700, 10, 1])] + [(7, None), (8, ""), (8, ""), (None, "x")]
    got = packing.pack(spark.createDataFrame(rows, DOCS).withColumn("offset", F.lit(1)), TOKENIZER).collect()
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(seqs) == -(-total // 2048)
    assert [r["length"] for r in got if r["doc_id"] == 7] == [1] and sum(r["doc_id"] == 8 for r in got) == 2
    assert packing.pack(spark.createDataFrame([], DOCS), TOKENIZER).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_capacity(rule):
    sizes = np.sort(np.random.default_rng(1).integers(1, 700, 300))[::-1]
    cap = packing.Capacity(1000, 4, 500_000, (1.0, 0.2, 0.5), rule)
    bins, offsets, n = packing.best_fit(sizes, cap)
    for b in range(len(n)):
        mine = sizes[bins == b]
        assert mine.sum() <= 1000 and len(mine) <= 4 and (mine.astype(float) ** 2).sum() <= 500_000
        assert sorted(offsets[bins == b]) == sorted(np.cumsum(mine) - mine)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([900]), packing.Capacity(1000, attention=100))


def test_query_and_stage_weigh_every_capacity(monkeypatch):
    import corpus_pipeline
    from assayworks.llm import queries

    seen = []
    monkeypatch.setattr(packing, "pack", lambda docs, path, cap=None: seen.append(cap or packing.Capacity()))
    monkeypatch.setattr(queries, "table", lambda *a: None)
    queries.op4_best_fit_packing(None, "")
    corpus_pipeline.best_fit_packing(None, None, "")
    assert len(seen) == 2 and all(min(c.weights) > 0 and c.tokens == 2048 for c in seen)


def test_pii_terms(spark):
    rows = [(i, f"number {WORDS[i]} mentions zanzibarproject near kim@example.org {WORDS[i + 1]}") for i in range(5)]
    rows += [(5, "zanzibarproject again"), (6, None), (7, ""), (8, "call +49 (30) 123-4567 9 or 4111 1111 1111 1111, 10.0.0.1")]
    rows += [(100 + i, f"number of mentions near {prose(9, i)}") for i in range(60)]
    df = spark.createDataFrame(rows + [rows[0]], DOCS).withColumn("h", F.lit("clash")).withColumn("_h", F.lit(3))
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    assert got[5]["spans"] == "term:0:15" and got[6]["spans"] == "" and got[100]["spans"] == ""
    assert (got[8]["n_phone"], got[8]["n_card"], got[8]["n_ip"], got[0]["n_email"]) == (1, 1, 1, 1)
    clean = pii.sanitise(df)
    assert clean.columns == df.columns and {(r["h"], r["_h"]) for r in clean.collect()} == {("clash", 3)}
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert text[5] == "[EMAIL TERM] again" and text[6] is None and text[100] == dict(rows)[100]
    assert text[8] == "call [PHONE] or [CARD], [IP]" and "kim" not in text[0] and "[EMAIL]" in text[0]
    assert pii.report(df.where("false")).count() == 0


def test_pii_terms_of_cut_windows_and_whole_texts(spark):
    far = " ".join(["zz"] * 40)  # 119 characters, no terms
    # a whole term at the edge of the window, the edge on a gap: 81 characters reach to its first letter
    edge = [(i, f"{WORDS[i]}aa {'quokkaland' + ' 1' * 35} kim@example.org") for i in range(5)]
    # beside the entity in 4 texts, far off in 3 more
    whole = [(10 + i, f"{WORDS[i]}bb numbatcity bob@example.org") for i in range(4)] + [(20 + i, f"numbatcity {WORDS[i]}cc {far} bob@example.org") for i in range(3)]
    rest = [(100 + i, prose(9, i)) for i in range(90)]
    assert edge[0][1].index("kim@") - edge[0][1].index("quokkaland") == 81
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(edge + whole + rest + whole[:1], DOCS), pii.Disclosure(reach=81)).collect()}
    assert all("term:" in got[i] for i in (*range(5), *range(10, 14), *range(20, 23))) and got[100] == ""


def test_decontamination(spark):
    passage = prose(25, 99)
    w = passage.split()
    docs = [(0, "x, " + passage.upper() + "! y"), (1, " ".join(w[:9])), (2, None), (3, ""), (4, "Little item."), (5, prose(50, 5)), (0, passage)]
    bench = spark.createDataFrame([(1, passage), (2, None), (3, "little ITEM"), (1, passage), (None, passage)], "item_id long, text string")
    df = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("clash") for c in ("items", "_n", "n_words", "id", "row")})
    got = decontamination.contamination(df, bench).collect()
    hits = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in got)
    assert hits == [(0, 25, 25, 1), (0, 27, 25, 1), (1, 9, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 2, 2, 1), (5, 50, 0, 0)]
    clean = decontamination.decontaminate(df, bench)
    assert clean.columns == df.columns and {r["_n"] for r in clean.collect()} == {"clash"}
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 3, 5]
    spans = [r["text"] for r in decontamination.decontaminate(df, bench, "spans").where("doc_id = 0").collect()]
    assert len(spans) == 1 and re.findall(r"\w+", spans[0]) == ["x", "y"]
    assert decontamination.contamination(df, bench.where("false")).where("contaminated").count() == 0
    assert decontamination.contamination(df.where("false"), bench).count() == 0
    named = bench.withColumn("item_id", F.concat(F.lit("item-"), F.col("item_id").cast("string")))
    assert {x for r in decontamination.contamination(df, named).collect() for x in r["items"]} == {"item-1", "item-3"}


def test_decontamination_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_LONGS", 16)  # nearly every window goes to the join
    items = [(i, prose(60, 1000 + i)) for i in range(40)]
    docs = [(i, prose(30, i) + " " + (" ".join(items[i][1].split()[5 : 5 + i]) if i < 40 else "") + " " + prose(20, i + 500)) for i in range(60)]
    docs += [(100, prose(30_000, 77) + " " + items[7][1])]
    got = {r["doc_id"]: r for r in decontamination.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()}
    windows = {tuple(t.split()[k : k + 10]): i for i, t in items for k in range(51)}
    for i, t in docs:
        w = t.split()
        at = [k for k in range(len(w) - 9) if tuple(w[k : k + 10]) in windows]
        assert got[i]["n_hit"] == len({p for k in at for p in range(k, k + 10)}) and got[i]["contaminated"] == bool(at)
        assert sorted(got[i]["items"]) == sorted({windows[tuple(w[k : k + 10])] for k in at})


def test_toxicity(spark):
    toxic = [(i, f"{prose(30, i)} grumblefoot {prose(5, i)}") for i in range(40)]
    clean = [(i, prose(35, i)) for i in range(40, 140)]
    odd = [(500, "you gr" + "u" * 6 + "mblefoot"), (501, "some grumb1ef00t"), (502, "a g r u m b l e f o o t there"), (503, None), (504, ""), (505, "ok")]
    df = spark.createDataFrame(toxic + clean + odd, DOCS).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(i, 0) for i in range(40, 140)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(df, labels).collect()}
    assert [got[i]["predicted"] for i in range(500, 506)] == [1, 1, 1, 0, 0, 0]
    assert all(got[i]["predicted"] == 1 for i in range(40)) and sum(got[i]["predicted"] for i in range(40, 140)) == 0
    assert toxicity.score(df, labels.where("false")).where("predicted = 1").count() == 0


def test_rare_toxic_evidence_is_kept(spark):
    common = "common phrase of every text"
    rows = [(i, f"{common} rareslur{'x' if i % 8 else 'yyqq'}") for i in range(40)] + [(i, f"{common} {prose(5, i)}") for i in range(40, 140)]
    rows += [(500, "a rareslurx"), (501, "$rare"), (502, None), (500, "a rareslurx"), (None, "common")]
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(140)], "doc_id long, toxic int")
    results = []
    for most in (200_000, 3):  # sent as a whole, and joined
        got = toxicity.score(df, labels, toxicity.Training(most_broadcast=most)).collect()
        results.append(sorted((r["doc_id"] or -1, r["held_out"], round(r["score"], 9), r["predicted"]) for r in got))
    assert results[0] == results[1] and len(results[0]) == len(rows)
    assert [x[3] for x in results[0] if x[0] == 500] == [1, 1] and [x[2] for x in results[0] if x[0] == 502] == [toxicity.FLOOR]


def test_disguised_tokens_are_all_decoded():
    texts = " ".join(["stupid idiot shit asshole table word other"] * 50)
    restorer = toxicity.Restorer(toxicity.log_model(toxicity._trigrams(texts).reshape(27, 27, 27).astype(float)))
    want = {"$tupid": "stupid", "$tupid!": "stupid", "!diot": "idiot", "@sshole,": "asshole", "1d107": "idiot", "5h17": "shit",
            "word/" * 12 + "1d10t/other": "idiot", "-".join(["1d10t", *["table"] * 9]): "idiot", "st" + "u" * 60 + "p1d": "stupid"}
    for token, word in want.items():
        assert word in restorer.words(token), token
    assert "other" in restorer.words("word/" * 12 + "other") and restorer.words("table,") == ["table"]


def test_fragments_are_joined_and_runs_parted():
    texts = " ".join(["you are an idiot and stupid people the table is there for you"] * 200)
    restorer = toxicity.Restorer(toxicity.log_model(toxicity._trigrams(texts).reshape(27, 27, 27).astype(float)))
    want = {"i  d  i  o  t": "idiot", "i\td\ti\to\tt": "idiot", "i\nd\ni\no\nt": "idiot", "i/d/i/o/t": "idiot", "i,d,i,o,t": "idiot", "i|d|i|o|t": "idiot",
            "1 d 1 0 t": "idiot", "an id iot there": "idiot", "so stu pid there": "stupid", "y o u i d i o t": "idiot", " ".join("youareanidiot" * 5): "idiot"}
    for text, word in want.items():
        assert word in {w for t in toxicity.tokens(text, restorer) for w in restorer.words(t)}, text
    assert toxicity.tokens("you are an idiot", restorer) == {"you", "are", "an", "idiot"}


def test_sharding(spark):
    table = sharding.fill([f"s{k}" for k in range(7)], 1009)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and min(table) == 0
    clash = spark.createDataFrame([(i, "same", "x") for i in range(1, 5)], "doc_id long, _key string, slot string")
    assert {r["doc_id"]: r["slot"] for r in sharding.place(clash, "doc_id", ["a", "b"], 31).collect()} == {
        r["doc_id"]: r["slot"] for r in sharding.place(clash.select("doc_id"), "doc_id", ["a", "b"], 31).collect()
    }
    assert sharding.place(clash, "slot", ["a", "b"], 31).columns == ["doc_id", "_key", "slot", "shard"]
    fewer = sharding.fill([f"s{k}" for k in range(6)], 1009)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6) < 0.2 * 1009
    weighted = np.bincount(sharding.fill(["a", "b"], 101, [1, 3]))
    assert weighted[1] > 2.5 * weighted[0]
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "doc_id long, shard string")
    got = sharding.place(df, "doc_id", ["a", "b"], 101).collect()
    assert len(got) == 3 and len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad, 101)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, centers = [], rng.standard_normal((150, 16))
    for i in range(1500):
        v = centers[i % 150] + rng.standard_normal(16) * 0.12
        rows.append((i, [float(x) for x in v], int(i % 150 % 3)))
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1), (2004, rows[0][1], None), (2005, rows[0][1], 0), (2006, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kind", F.lit("clash"))
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & np.equal.outer([r[2] for r in good], [r[2] for r in good])
    want = near.sum(axis=1) - 1
    # trees grown in one task; trees from a sample; a sample that misses labels; a dense node in blocks
    for forest in (vector_dedup.Forest(), vector_dedup.Forest(block=150), vector_dedup.Forest(block=150, sample=40), vector_dedup.Forest(block=40, leaf=5000)):
        got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(df, forest).collect()}
        assert len(got) == len(rows)
        found = np.array([got[r[0]]["n_links"] for r in good])
        assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (2000, 2001, 2002, 2003, 2004, 2006))
        assert got[2005]["component_id"] <= 0
    assert vector_dedup.near_duplicates(df.where("false")).count() == 0


def test_trees_split_and_find(spark):
    """Whole recall is 1.0 here: 2400 vectors of 64 dimensions split into leaves of 32, each pair found in some tree."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((1200, 64))
    noise = rng.standard_normal((1200, 64)) * rng.uniform(0.05, 0.45, (1200, 1))
    x = np.concatenate([base, base + noise])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    trees = vector_dedup.fit(unit, len(unit), vector_dedup.Forest())
    assert min(len(t) for t in trees) > 30
    want = int(((unit @ unit.T) >= 0.93).sum() - len(x))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    for forest in (vector_dedup.Forest(), vector_dedup.Forest(block=500)):
        found = sum(r["n_links"] for r in vector_dedup.near_duplicates(df, forest).collect())
        assert 0.99 * want <= found <= want, (found, want)


def test_licenses(spark):
    rows = [(0, prose(40, 1) + " Released under the MIT license. " + prose(300, 2)), (1, licenses.TEMPLATES["GPL-3.0-header"]), (2, None), (3, ""), (4, "released under"), (5, prose(50, 3)),
            (6, ("Licensed under the Apache License, Version 2.0. " * 3) + "Licensed under CC BY-NC 4.0")]
    df = spark.createDataFrame(rows + rows[:1], DOCS).withColumns({c: F.lit("clash") for c in ("hit", "sh", "found", "id")})
    got = [(r["doc_id"], [m["license"] for m in r["matches"]]) for r in licenses.scan(df).collect()]
    assert sorted(got) == [(0, ["MIT"]), (0, ["MIT"]), (1, ["GPL-3.0-header"]), (2, []), (3, []), (4, []), (5, []), (6, ["Apache-2.0", "CC-BY-NC-4.0"])]
    assert licenses.scan(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(df, {"x": "too short"})


def test_whole_licenses_brute_force(spark):
    """Whole texts, with words changed, in long documents: bands find what exact shares over all windows find."""
    rng = random.Random(12)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    grams = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, words(v)) for k, v in licenses.TEMPLATES.items())}
    rows = []
    for i in range(120):
        name = rng.choice([k for k in grams if len(grams[k]) > 64])
        w = licenses.TEMPLATES[name].split()
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, prose(rng.randint(0, 300), i) + " " + " ".join(w) + " " + prose(rng.randint(0, 3000), i + 999)))
    got = {r["doc_id"]: {m["license"]: (round(m["share"], 9), m["at"]) for m in r["matches"]} for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    wanted = missed = 0
    for i, t in rows:
        w = words(t)
        of = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        for name, g in grams.items():
            step = licenses.block_of(licenses.class_of(len(g)))
            best = max((len(g & set(of[a : a + 5 * step])) / len(g), -a) for a in range(0, len(of), step))
            if best[0] >= 0.8:
                wanted += 1
                missed += name not in got[i]
                assert name not in got[i] or got[i][name] == (round(best[0], 9), -best[1])
            else:
                assert name not in got[i]
    assert wanted > 120 and missed <= 0.01 * wanted


def test_shared_dir_is_the_sessions(spark):
    from assayworks.llm.shared import shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
