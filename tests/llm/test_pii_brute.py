"""Base spans, their digest and the disclosing terms against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from assayworks.llm import pii

DOCS = "doc_id long, text string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind, x):
    digits = re.sub("[^0-9]", "", x)
    if kind == "ip":
        return all(int(p) <= 255 for p in x.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        out += [(m.start(), i, m.end(), kind, m[0]) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(out)


def random_text(rng, n):
    bits = ["a@b.c", "x.y+z@host-1.example.org", "@", "1.2.3.4", "256.1.1.1", "10.0.0.255.7.8.9.10", "4111 1111 1111 1111", "4111-1111-1111-1112", "5" * 25,
            "+49 (30) 123-4567 9", "+1 2", "12 34 56", "é", "漢字", "😀", "..", "-", "3 782822463 10005", "a@b", "+", "0001.002.003.004", "1.2.3", "word"]
    return "".join(rng.choice(bits) + rng.choice(["", " ", ".", "-", "\n"]) for _ in range(n))


def test_base_spans(spark):
    rng = random.Random(8)
    rows = [(i, random_text(rng, rng.randint(0, 40))) for i in range(300)] + [(900, None), (901, ""), (902, random_text(rng, 3000)), (903, "1 " * 5000 + "a@b.c " * 700)]
    got = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = spans(text)
        named = ",".join(f"{k}:{a}:{b}" for a, _, b, k, _ in want)
        assert got[i]["base_sha256"] == hashlib.sha256(named.encode()).hexdigest(), (i, text, named, got[i]["spans"])
        kinds = Counter(x[3] for x in want)
        assert all(got[i][f"n_{k}"] == kinds[k] for k in PATTERNS)


SECRET = re.compile(r"(?<![^\W_])[A-Za-z0-9]{16,}(?![^\W_])")


def secrets(text):
    found = [(m.start(), 4, m.end(), "secret", m[0]) for m in SECRET.finditer(text or "")]
    return [x for x in found if re.search("[0-9][A-Za-z]", x[4]) and re.search("[A-Za-z][0-9]", x[4])]


def brute_terms(texts, d):
    """Masked terms with their shares."""
    texts = sorted(set(texts))
    letters = lambda s: {w for w in re.findall(r"[^\W_]+", s.lower()) if len(w) >= d.shortest and re.search(r"[^\W\d_]", w)}
    near, holds, has, kinds, beside, goes = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        for w in letters(t):
            has[w].add(t)
        found = sorted(spans(t) + secrets(t))
        rest = list(t)
        for a, rank, b, _, x in found:
            rest[a:b] = "." * (b - a)
        for a, rank, b, _, x in found:
            entity = (rank, x.lower() if rank == 0 else x if rank == 4 else re.sub("[^0-9.]", "", x))
            holds[entity].add(t)
            kinds[rank].add(t)
            for w in letters("".join(rest)):
                beside[w, rank].add(t)
                goes[w, rank].add(entity)
            for m in re.finditer(r"[^\W_]+", t):
                if (m.end() <= a and m.start() >= a - d.reach) or (m.start() >= b and m.end() <= b + d.reach):
                    for w in letters(m[0]):
                        near[w, entity].add(t)
    told = {}
    for (w, e), where in near.items():
        share = len(has[w] & holds[e]) / len(has[w])
        if len(where) >= d.support and share >= d.disclosure and math.log2(share / (len(holds[e]) / len(texts))) >= d.bits:
            told[w] = max(told.get(w, 0), share)
    for (w, k), where in beside.items():  # texts here hold one entity of a kind at most
        share = len(where) / len(has[w])
        if len(goes[w, k]) >= d.values and share >= d.disclosure and math.log2(share / (len(kinds[k]) / len(texts))) >= d.bits:
            told[w] = max(told.get(w, 0), share)
    return told


@pytest.mark.parametrize("few", [0, 200_000])  # tables joined by shuffle, and broadcast
def test_terms(spark, few):
    rng = random.Random(3)
    words = ["w" + "".join(rng.choice("abcdefg") for _ in range(3)) for _ in range(60)]
    mails = [f"m{k}@example.org" for k in range(4)]
    rows = []
    for i in range(260):
        w = [rng.choice(words) for _ in range(rng.randint(3, 30))]
        if i % 4 == 0:
            k = i // 4 % 4
            w.insert(rng.randint(0, len(w)), f"{mails[k]} nick{k}" if rng.random() < 0.8 else mails[k])
            if rng.random() < 0.3:
                w.append(f"firm{k}")
        elif rng.random() < 0.02:
            w.append(f"nick{i % 4}")
        rows.append((i, " ".join(w)))
    for i in range(12):  # cues that go with ever other values, once also in a near copy
        rows.append((300 + i, f"{' '.join(rng.sample(words, 6))} the pass is {rng.randbytes(10).hex()}a1b2 keep"))
        rows.append((330 + i, f"copied {' '.join(rng.sample(words, 6))} f00ba2f00ba2f00ba2 {'x' * i}"))
    rows.append((350, "a pass to go"))
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # one text of many rows
    d = pii.Disclosure(broadcast_terms=few, broadcast_texts=few, broadcast_spans=few)
    want = brute_terms([t for _, t in rows], d)
    assert any(k.startswith("nick") for k in want) and "pass" in want
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(rows, DOCS), d).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, DOCS), d).collect()}
    assert len(clean) == len(got) == len(rows)
    for i, t in rows:
        terms = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in want]
        assert [x for x in got[i].split(",") if x.startswith("term")] == [f"term:{a}:{b}" for a, b in terms], t
        assert not {m[0].lower() for m in re.finditer(r"[^\W_]+", re.sub(r"\[[A-Z ]+\]", "", clean[i]))} & set(want) and "@" not in clean[i]
