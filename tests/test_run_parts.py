"""Parts of a run: text forms, documents, judges behind HTTP, prompts, vectors, retrieval, traces, the run from files."""

import io
import json
import os
import random
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assayworks.functions import sequences
from assayworks.operators import chat, embedding, judge, prompts, retrieval, schema
from assayworks.operators.contract import ContractError
from assayworks.operators.units import unpack, with_positions
from assayworks.plans import monitoring
from assayworks.sources import documents, loading, traces


# --- text forms


def test_text_forms():
    turn = ["q", 'in "x" it\'s', "out\n\\ é 漢"]
    rows = [turn, ["q2", "", None]]
    arrays = [np.array(r, dtype=object) for r in rows]
    printed = np.empty(2, object)
    printed[:] = arrays
    forms = [json.dumps(rows), json.dumps(rows, ensure_ascii=False), str(rows), str([tuple(r) for r in rows]), str(arrays), repr(printed), "[" + "\n ".join(map(repr, arrays)) + "]"]
    assert all(sequences.turns(f) == rows for f in forms), [sequences.turns(f) for f in forms]
    for bad in ("", "nonsense", "[1,", "[[1, 2]", "__import__('os')", "f([1])", "[1 2]", "{'a': 1}", "[[1], 2]", "array()"):
        assert sequences.turns(bad) is None, bad
    rng = random.Random(2)
    for _ in range(300):  # any list of lists of texts comes back from its printed form
        made = [["".join(rng.choice("ab'\"\\\n,[]() é\t") for _ in range(rng.randint(0, 9))) for _ in range(3)] for _ in range(rng.randint(1, 3))]
        assert sequences.turns(str(made)) == made and sequences.turns(str([np.array(t, dtype=object) for t in made])) == made


def test_unpack_text(spark):
    rows = [(0, "s", '[["a","b","c"]]'), (1, "s", "[('x', 'y', 'z'), (None, 'v', 'w')]"), (2, None, "[array(['1','2','3'], dtype=object)\n array(['4','5','6'], dtype=object)]")]
    got = unpack(spark.createDataFrame(rows, "_pos long, session_id string, dialogue string")).orderBy("_pos").collect()
    assert [(r["reference_group_id"], r["query_id"], r["output_answer"]) for r in got] == [("s", "a", "c"), ("s#2", "x", "z"), ("s#2", "s#2-t2", "w"), ("session-3", "1", "3"), ("session-3", "4", "6")]
    with pytest.raises(PySparkException):
        unpack(spark.createDataFrame([(0, "s", "no list")], "_pos long, session_id string, dialogue string")).collect()


def test_positions(spark):
    df = with_positions(spark.range(1000).select((F.col("id") * 7919 % 13).alias("a"), "id"), ["a", "id"])
    rows = sorted((r["a"], r["id"], r["_pos"]) for r in df.collect())
    assert [r[2] for r in rows] == list(range(1000))


# --- documents

_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(*blocks):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {_W}><w:body>{''.join(blocks)}<w:sectPr/></w:body></w:document>")
    return out.getvalue()


def paragraph(text):
    return f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"


def xlsx(rows):
    out, ns = io.BytesIO(), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    r = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cells = "".join(
        f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + j)}{i}"><v>{v}</v></c>' for j, v in enumerate(row) if v is not None) + "</row>"
        for i, row in enumerate(rows, 1)
    )
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {r}><sheets><sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


def pdf(*lines):
    import zlib

    body = zlib.compress(b"BT /F1 12 Tf " + b" T* ".join(b"(" + x.replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj" for x in lines) + b" ET")
    return b"%PDF-1.4\n1 0 obj <</Filter /FlateDecode /Length " + str(len(body)).encode() + b">>\nstream\n" + body + b"\nendstream endobj\n%%EOF"


def test_formats():
    table = "<w:tbl><w:tr><w:tc>" + paragraph("a") + "</w:tc><w:tc>" + paragraph("b") + "</w:tc></w:tr></w:tbl>"
    inner = "<w:sdt><w:sdtContent>" + paragraph("in") + "</w:sdtContent></w:sdt>"
    assert documents.docx_text(docx(paragraph("one"), table, inner, paragraph("end"))) == "one\na\tb\nin\nend"
    assert documents.xlsx_rows(xlsx([["k", "v"], ["a", 1], [None, 2.5]])) == [["k", "v"], ["a", "1"], [None, "2.5"]]
    assert documents.pdf_text(pdf(b"first (line)", b"second")) == "first (line)\nsecond"
    with pytest.raises(ValueError):
        documents.pdf_text(pdf())


def test_document_sets(spark, tmp_path):
    folder = tmp_path / "docs"
    (folder / "deep").mkdir(parents=True)
    for name, data in {"a.txt": "﻿text é".encode(), "B.DOCX": docx(paragraph("word")), "c.xlsx": xlsx([["k", "v"]]), "d.pdf": pdf(b"page"), "e.csv": b"x,y\n1,2", "bad.pdf": b"no", "old.doc": b"\xd0\xcf", "skip.bin": b"?"}.items():
        (folder / name).write_bytes(data)
    (folder / "deep" / "f.md").write_text("deep")
    got = {r["source"]: (r["content"], r["error"]) for r in documents.load_documents(spark, str(folder)).collect()}
    assert {k: v[0] for k, v in got.items() if v[0] is not None} == {"a.txt": "text é", "B.DOCX": "word", "c.xlsx": "k\tv", "d.pdf": "page", "e.csv": "x,y\n1,2"}
    assert set(got) - {"bad.pdf", "old.doc"} == {"a.txt", "B.DOCX", "c.xlsx", "d.pdf", "e.csv"} and got["bad.pdf"][1]
    assert "f.md" in {r["source"] for r in documents.load_documents(spark, str(folder), nested=True).collect()}
    archive = str(tmp_path / "z.zip")
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("in/n.txt", "x")
        z.writestr("bad.pdf", "no")
        z.writestr("skip.bin", "?")
    assert [tuple(r) for r in documents.archive_documents(spark, archive).collect()] == [("n.txt", "x")]
    assert os.path.exists(os.path.join(documents.extract_zip(archive), "in", "n.txt"))
    assert documents.remove_directory(str(tmp_path / "z")) and not documents.remove_directory(str(tmp_path / "z"))
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("../out.txt", "x")
    with pytest.raises(ContractError):
        documents.extract_zip(archive)
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    (tmp_path / "empty.zip").write_bytes(b"")
    with zipfile.ZipFile(str(tmp_path / "useless.zip"), "w") as z:
        z.writestr("a.bin", "x")
        z.writestr("bad.pdf", "no")
    for bad in ("broken.zip", "none.zip", "empty.zip", "useless.zip"):
        with pytest.warns(UserWarning, match="going on without"):
            assert documents.archive_documents(spark, str(tmp_path / bad)) is None
    assert documents.archive_documents(spark, None) is None


def test_instructions(tmp_path):
    one = tmp_path / "one"
    one.mkdir()
    (one / "i.docx").write_bytes(docx(paragraph("do it")))
    (one / ".hidden.txt").write_text("x")
    assert documents.load_instruction(str(one)) == "do it" and documents.load_instruction(None) == "" and documents.load_instruction({"text": "t"}) == "t"
    (tmp_path / "plain").write_bytes((one / "i.docx").read_bytes())
    (tmp_path / "blank.txt").write_text(" \n")
    assert documents.load_instruction(tmp_path / "plain") == "do it"
    (one / "j.txt").write_text("two")
    for bad in (one, tmp_path / "blank.txt", {"text": ""}):
        with pytest.raises(ContractError):
            documents.load_instruction(bad)
    with pytest.raises(FileNotFoundError):
        documents.load_instruction(str(tmp_path / "none.txt"))


def test_tables(spark, tmp_path):
    buffer = io.BytesIO()
    pd.DataFrame({"a": [1, 2], "b": ["x", None]}).to_parquet(buffer)
    assert sorted(r["a"] for r in loading.load_monitoring(spark, buffer.getvalue()).collect()) == [1, 2]
    with pytest.raises(ContractError):
        loading.load_table(spark, b"no parquet")
    with pytest.raises(ContractError):
        loading.load_monitoring(spark, "x.csv")
    with pytest.raises(ContractError):
        loading.load_monitoring(spark, 3)
    (tmp_path / "t.xlsx").write_bytes(xlsx([["a", "b"], ["1", "x"]]))
    assert [tuple(r) for r in loading.load_table(spark, str(tmp_path)).collect()] == [("1", "x")]


# --- judges


class Service(BaseHTTPRequestHandler):
    seen: list = []
    refusals = 0
    lost = False

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Service.seen.append((self.path, self.headers.get("Authorization"), body))
        if Service.refusals > 0:
            Service.refusals -= 1
            self.send_response(429)
            self.send_header("Retry-After", "0.01")
            self.end_headers()
            return
        prompt = body["messages"][0]["content"]
        if Service.lost:
            content = ""
        else:
            value = "1.0" if "word1" in prompt.split("To assess:")[-1] else "0.0"
            content = '<think>{"good": "9"}</think> so: {"answer": {"good": "%s"}}' % value
        out = json.dumps({"id": "r", "choices": [{"message": {"content": [{"text": content}]}, "finish_reason": "stop"}]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(out)

    def log_message(self, *a):
        pass


@pytest.fixture
def service():
    server = HTTPServer(("127.0.0.1", 0), Service)
    Service.seen, Service.refusals, Service.lost = [], 0, False
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/"
    server.shutdown()


GOOD = schema.Scale("good", "double", (0.0, 1.0), False, True)


def test_http_judge(service, monkeypatch):
    monkeypatch.setenv("TEST_KEY", "k")
    config = chat.JudgeConfig(service, "m", key_variable="TEST_KEY", temperature=0.5)
    asked = config.build([GOOD])
    Service.refusals = 2
    slept = []
    assert judge.ask(asked, ["To assess: word1", "To assess: x"], sleep=slept.append) == [('{"good": 1.0}', None), ('{"good": 0.0}', None)]
    path, auth, body = Service.seen[-1]
    assert path == "/v1/chat/completions" and auth == "Bearer k" and body["temperature"] == 0.5 and "top_p" not in body and body["messages"][-1]["content"].endswith('{"good": null}')
    assert slept == [0.01, 0.01]
    Service.lost = True
    (answer, error), = judge.ask(asked, ["x"], sleep=slept.append)
    assert answer is None and "nothing was answered" in error and slept[2:] == [3]
    monkeypatch.setenv("JUDGE_MODEL", "from the environment")
    assert chat.JudgeConfig(service).chosen() == "from the environment" and chat.JudgeConfig(service, "own").chosen() == "own"
    with pytest.raises(ValueError):
        chat.JudgeConfig().build()


def test_messages():
    assert chat.as_chat("p") == [{"role": "user", "content": "p"}]
    got = chat.as_chat([("system", "s"), ("human", ["a", {"text": "b"}, {"image": 1}]), ("ai", {"text": "c"})])
    assert got == [{"role": "system", "content": "s"}, {"role": "user", "content": "ab"}, {"role": "assistant", "content": "c"}]
    assert chat.reply({"choices": [{"message": {"content": ["x", {"text": "y"}]}}]}) == "xy"
    for bad in ({}, {"choices": []}, {"choices": [{}]}, {"choices": [{"message": {"content": " "}}]}, {"choices": {"a": 1}}, None):
        with pytest.raises(judge.JudgeError, match="nothing was answered"):
            chat.reply(bad)


def test_answers_on_scales(spark):
    df = spark.createDataFrame([(1, "x", True, 0.5), (2, "y", False, None)], "n int, t string, b boolean, d double")
    strict, plain = schema.strict_scales(df, df.columns), schema.labelled_scales(df, df.columns, {"n": "how many"})
    assert schema.validate_answer({"n": 1, "t": "x", "b": True, "d": None}, strict) == (True, [])
    assert schema.read_answer({"answer": {"n": "2", "t": "y", "b": "False", "d": "0.5"}}, plain) == {"n": 2, "t": "y", "b": False, "d": 0.5}
    ok, wrong = schema.validate_answer({"n": 3, "t": "x", "d": 0.5}, strict)
    assert not ok and len(wrong) == 2
    for bad in ({"answer": 1}, {"properties": {}}, {}):
        with pytest.raises(ContractError):
            schema.read_answer(bad, strict)
    made = schema.json_schema(plain)
    assert made["properties"]["n"]["enum"] == ["1", "2"] and made["properties"]["n"]["description"] == "how many" and made["required"] == ["n", "t", "b"]
    raw = spark.createDataFrame([('{"n": "1", "b": true, "d": 0.5}',), ('{"answer": {"n": 7, "t": "y", "b": "False"}}',)], "raw string")
    assert [tuple(r) for r in raw.select(*schema.parse_answers(F.col("raw"), plain)).collect()] == [(1, None, True, 0.5), (None, "y", False, None)]
    with pytest.raises(ContractError):
        schema.Scale("s", "string", ("1", 1), False, True).labels()


def test_votes_over_runs(spark):
    scales = [schema.Scale("c", "long", (1, 2, 3), False)]
    rows = [("a", i, json.dumps({"c": v})) for i, v in enumerate([2, 1, 1])] + [("b", i, json.dumps({"c": v})) for i, v in enumerate([3, 2, 9])] + [("n", i, None) for i in range(3)]
    got = {r["_unit_id"]: r for r in judge.voted(spark.createDataFrame(rows, "_unit_id string, run int, answer string"), scales, 3).collect()}
    assert got["a"]["agent_c"] == 1 and got["b"]["agent_c"] == 3 and got["b"]["agent_2_c"] is None and got["n"]["agent_c"] is None
    with pytest.raises(ValueError):
        judge.in_runs(spark.range(1), 0)


def test_judged_and_failures(spark):
    def odd(texts):
        return [RuntimeError("no") if "7" in t else f"<{t}>" for t in texts]

    units = spark.range(20).select(F.col("id").cast("string").alias("_unit_id"), F.col("id").cast("string").alias("p"))
    got = judge.judged(units, "p", odd, delay=0.0, sleep=_no_sleep).toPandas().set_index("_unit_id")
    assert got.loc["3", "answer"] == "<3>" and got.loc["17", "error"] == "RuntimeError: no"
    answers = spark.createDataFrame(got.reset_index())
    assert judge.check_failures(answers) == {"asked": 20, "failed": 2}
    with pytest.raises(ContractError):
        judge.check_failures(answers, 0.05)


def _no_sleep(seconds):
    pass


def test_neighbour_judge_brute_force(spark):
    rng = random.Random(4)
    words = "a b c d e f g h i j k l m".split()
    examples = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(2, 8))), i % 3) for i in range(60)]
    units = [(k, " ".join(rng.choice(words) for _ in range(3))) for k in range(8)]
    ex, un = spark.createDataFrame(examples, "doc_idx int, text string, c int"), spark.createDataFrame(units, "query_id int, text string")
    scored = {}
    for r in retrieval.bm25(un, ex, every=True).collect():
        scored.setdefault(r["query_id"], []).append((round(r["score"], 9), r["doc_idx"]))
    for r in judge.neighbour_judge(un, ex, ["c"]).collect():
        near = [examples[d][2] for s, d in sorted((x for x in scored[r["query_id"]] if x[0] != 0), reverse=True)[:10]]
        assert r["agent_c"] == (max(dict.fromkeys(near), key=near.count) if near else None)


# --- prompts and vectors


def test_prompts(spark):
    units = spark.createDataFrame([("u", '{"x": 1}'), ("v", "t")], "query_id string, text string")
    examples = spark.createDataFrame([("u", "E")], "query_id string, examples string")
    got = {r["query_id"]: r["prompt"] for r in prompts.prompts(units, "Do", [GOOD], examples).collect()}
    assert "Do" in got["u"] and "E" in got["u"] and "0.0, 1.0" in got["u"] and prompts.NO_DOMAIN in got["v"] and "none" in got["v"]
    rec = spark.createDataFrame([(1, "é", None)], "b int, a string, c double")
    assert rec.select(prompts.record_json(rec, ["b", "a", "c"])).head()[0] == '{"a":"é","b":1,"c":null}'
    nan = spark.createDataFrame([(float("nan"),)], "c double")
    with pytest.raises(PySparkException):
        nan.select(prompts.record_json(nan, ["c"])).collect()
    words = spark.createDataFrame([("a Foo  b FOO foobar ",)], "t string")
    assert words.select(prompts.without_words(F.col("t"), ["foo"])).head()[0] == "a b bar"
    tries = []

    def rewrite(text):
        tries.append(text)
        if len(tries) < 3:
            raise RuntimeError
        return "better"

    assert prompts.structured("i", rewrite, sleep=lambda s: None) == "better"
    assert prompts.structured("i", lambda t: "", sleep=lambda s: None) == "i"
    first = prompts.numbered_by_first(spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "c")], "_pos long, k string"), "k")
    assert {r["k"]: r["place"] for r in first.collect()} == {"b": 0, "a": 1, "c": 2}
    assert prompts.context_columns(["_unit_id", "x", "good"], ["good"]) == ["x"]
    few = prompts.sampled_rows(spark.createDataFrame([(str(i) * 200, None if i else "m") for i in range(30)], "a string, b string"), ["a", "b"])
    assert few.count() == 15 and all(len(r["a"]) <= 150 and r["b"] == "m" for r in few.collect())


def letters(texts):
    return [[float(t.count(c)) for c in "abc"] + [float(len(t)) + 1] for t in texts]


def test_embedding(spark):
    calls = []

    def counted(texts):
        calls.append(len(texts))
        return letters(texts)

    texts = ["a" * 2500, "", "abc"]
    got = embedding.embed_texts(texts, counted, batch=2)
    assert got[0] == pytest.approx([2500 / 3, 0, 0, (1001 + 1001 + 501) / 3]) and got[1] == [0, 0, 0, 1] and calls == [2, 2, 1]
    df = embedding.embedded(spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int"), "t", letters)
    assert {r["n"]: list(r["vector"]) for r in df.collect()} == {1: [1, 1, 1, 4], 2: [0, 0, 0, 1]}
    with pytest.raises(ContractError):
        embedding.embed_texts(["x"], lambda t: [])
    with pytest.raises(ContractError):
        embedding.embed_texts(["x" * 1500], lambda t: [[1.0] * (i + 1) for i in range(len(t))])
    vectors = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],), ([],)], "v array<array<double>>")
    assert [r[0] for r in vectors.select(embedding.mean_vector(F.col("v"))).collect()] == [[2.0, 4.0], None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([([[1.0], [3.0, 6.0]],)], "v array<array<double>>").select(embedding.mean_vector(F.col("v"))).collect()


# --- retrieval


def test_hybrid_search_brute_force(spark):
    rng = random.Random(6)
    nprng = np.random.default_rng(6)
    words = "a b c d e f g h i j k l".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))), [float(x) for x in nprng.standard_normal(4)]) for i in range(50)]
    asked = [(q, t, [float(x) for x in nprng.standard_normal(4)]) for q, t in enumerate(["a b", "zz", "c c d", "l", ""])]
    corpus, queries = spark.createDataFrame(docs, "doc_idx int, text string, vector array<double>"), spark.createDataFrame(asked, "query_id int, text string, vector array<double>")
    k, beta = 8, 0.5
    scores = {(r["query_id"], r["doc_idx"]): r["score"] for r in retrieval.bm25(queries, corpus, every=True).collect()}
    cos = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    got = {}
    for r in retrieval.hybrid_search(queries, corpus, k, beta).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["doc_idx"], r["score"])
    for q, _, v in asked:
        near = sorted(((round(1 - (2 - 2 * cos(v, x)) / 2**0.5, 9), i) for i, _, x in docs), reverse=True)[:k]
        best = sorted(((round(scores[q, i], 9), i) for i, _, _ in docs), reverse=True)[:k]
        total = {i: (1 - beta) * s for s, i in near}
        n = len(docs)
        for r, (_, i) in enumerate(best, 1):
            total[i] = total.get(i, 0) + beta * (1 / (60 + r) - 1 / (60 + n)) / (1 / 61 - 1 / (60 + n))
        order = sorted(total, key=lambda i: -round(total[i], 9))[:k]
        assert [got[q][r][0] for r in range(1, k + 1)] == order and got[q][1][1] == pytest.approx(total[order[0]])


def test_dense_top_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    corpus = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(3)]) for i in range(40)] + [(99, [0.0] * 3), (100, None)], "doc_idx int, vector array<double>")
    queries = corpus.where("doc_idx < 20").withColumnRenamed("doc_idx", "query_id")
    want = sorted(tuple(r) for r in retrieval.top_k(retrieval.dense(queries, corpus).where("score is not null"), 3).select("query_id", "doc_idx", "rank").collect())
    for block in (4096, 8):
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", block)
        assert sorted(tuple(r) for r in retrieval.dense_top(queries, corpus, 3).select("query_id", "doc_idx", "rank").collect()) == want


def test_retrievers(spark):
    embed = lambda df, c: embedding.embedded(df, c, letters)
    pairs = spark.createDataFrame([("a a" + "x" * 5000, "1"), ("b b", "2"), ("c c", "3"), ("c c", "3")], "question string, answer string")
    index = retrieval.create_retriever("question_answer", pairs, embed)
    assert index.corpus.count() == 3 and (index.k, index.beta) == (10, 0.8)
    hits = index.search(embed(spark.createDataFrame([(0, "b")], "query_id int, text string"), "text"), k=1).join(index.corpus, "doc_idx").head()
    assert hits["answer"] == "2"
    chunks = spark.createDataFrame([("f", 0, "aaa about"), ("f", 0, "bbb about"), ("g", 1, "ccc")], "source string, chunk_id int, content string")
    widths = []

    def seen(df, c):
        widths.append(df.agg(F.max(F.length(c))).head()[0])
        return embed(df, c)

    subject = retrieval.create_retriever("content", chunks, seen)
    found = subject.search(spark.createDataFrame([(0, "bbb " + " " * 600 + "bbb")], "query_id int, text string"))
    assert (subject.k, subject.beta) == (5, 0.5) and found.join(subject.corpus, "doc_idx").orderBy("rank").head()["content"].startswith("bbb")
    assert widths == [9, 512]  # BM25 takes the query whole
    more = index.with_more(spark.createDataFrame([("b b", "2"), ("d d", "4")], "question string, answer string"))
    assert more.corpus.count() == 4
    for bad in (("other", pairs, embed), ("content", chunks, None)):
        with pytest.raises(ValueError):
            retrieval.create_retriever(*bad)


# --- traces


def spans(spark, rows):
    kinds = "_pos long, trace_id string, session_id string, aef_kind string, span_name string, input_text string, output_text string, start_time string, end_time string"
    return spark.createDataFrame([(i, t, "s" + t, kind, name, a, b, "2024-01-01 10:00:00", "2024-01-01 10:00:05") for i, (t, kind, name, a, b) in enumerate(rows)], kinds)


def update(q, a, scenario):
    return json.dumps({"graph": None, "update": {"scenario": scenario, "messages": [{"type": "human", "content": q}, {"type": "ai", "content": a}], "message_to_user": a}})


def test_trace_families(spark):
    noise = [(f"n{i}", "output_request", "web", "[]", "") for i in range(5)]
    exits = spans(spark, noise + [(f"t{i}", "chain", "exit", "{}", update(f"q{i}", f"a{i}", "rag" if i % 2 else "pick")) for i in range(3)])
    out = traces.convert(exits.drop("_pos"))
    assert tuple(out.columns) == traces.CANONICAL and sorted((r["query_id"], r["input_query"], r["output_answer"], r["endtime"]) for r in out.collect())[0] == ("t0", "q0", "a0", "2024-01-01 10:00:05")
    state = []
    for i in range(3):
        body = {"messages": [{"type": "human", "content": f"q{i}"}], "current_phrase": f"q{i}", "stage": "external", "message_to_user": None}
        state.append((f"t{i}", "chain", "graph", json.dumps(body), ""))
        state.append((f"t{i}", "chain", "graph", json.dumps({**body, "messages": [*body["messages"], {"type": "ai", "content": f"a{i}"}], "message_to_user": f"a{i}"}), ""))
    held = spans(spark, state)
    fields = {"question_field": "input_text", "answer_field": "input_text"}
    assert sorted((r["input_query"], r["output_answer"]) for r in traces.convert(held, ("graph",), **fields).collect()) == [(f"q{i}", f"a{i}") for i in range(3)]
    assert traces.convert(held, ("graph",), dedup=False, **fields).count() == 6
    envelope = json.dumps({"outgoing": {"content": {"message": [{"type": "text", "value": "a"}, {"type": "text", "value": "b"}]}}, "new_state": {"messages": [{"type": "human", "content": "q"}]}})
    got = traces.convert(spans(spark, [("f", "input_request", "x", "{}", envelope)]), (), ("input_request",)).head()
    assert (got["input_query"], got["output_answer"]) == ("q", "a\nb")
    routed = traces.convert(exits, route_keys=("scenario",))
    assert {r["route"] for r in routed.collect()} == {"rag", "pick"} == {r["output_answer"] for r in routed.collect()}
    with pytest.raises(traces.ConversionError, match="graph"):
        traces.convert(held)
    with pytest.raises(traces.ConversionError, match="0 spans"):
        traces.convert(held.where("false"))
    assert traces.convert(held.where("false"), allow_empty=True).columns == list(traces.CANONICAL)
    with pytest.raises(traces.ConversionError, match="no dialogue"):
        traces.convert(spans(spark, [("t", "chain", "exit", "{}", '{"noise": 1}')]))
    with pytest.raises(traces.ConversionError, match="one class"):
        traces.convert(exits.where("trace_id = 't1'"), route_keys=("scenario",))
    with pytest.raises(traces.ConversionError, match="vocabulary"):
        traces.convert(exits, route_keys=("scenario",), basket_answers=("rag",))
    assert traces.convert(exits, route_keys=("scenario",), basket_answers=("rag", "pick")).count() == 3
    buffer = io.BytesIO()
    exits.toPandas().to_parquet(buffer)
    node = traces.convert_node(spark, buffer.getvalue(), span_name="('exit',)", aef_kind="('chain',)", route_keys="('scenario',)", postulation="classification", dedup="true", allow_empty="false")
    assert set(node) == {"result"} and {r["output_answer"] for r in node["result"].collect()} == {"rag", "pick"}


# --- the run


def contract(method="mean_criteria", mode="qa", policy="exclude_value", sources=None):
    return {
        "contract_version": "laim-monitoring-metric.v2", "umr_version": "laim-umr.v2", "status": "computed", "basket_id": "b", "name": "m",
        "score_column": "main_metric", "assessment_mode": mode,
        "scoring": {"method": method, "missing_policy": policy, "sources": sources or [{"source_id": "good", "column_name": "good", "role": "criterion"}]},
        "aggregation": {"method": "mean"}, "baseline": {"value": 1, "recomputed_value": 1, "scale": "ratio"}, "primary_validation": {"affects_monitoring": False},
    }


def units(spark, n=12):
    rows = [(i, f"q{i}", f"word{i % 2} same{i % 2}", "ans", float(i % 2)) for i in range(n)]
    return spark.createDataFrame(rows, "_pos long, query_id string, input_query string, output_answer string, good double")


def test_run_with_a_service(spark, service, tmp_path):
    (tmp_path / "i.txt").write_text("Judge well")
    archive = str(tmp_path / "subject.zip")
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("a.txt", "word1 is right")
    embed = lambda df, c: embedding.embedded(df, c, letters)
    out = monitoring.main(
        spark, units(spark), contract(policy="fail"), chat.JudgeConfig(service, "m"), embed, str(tmp_path / "i.txt"), units(spark).drop("good"),
        domain_rag_files_zip=archive, num_assessors=3, delay=0.0, sleep=_no_sleep,
    )
    told = out.assessment_result
    assert (told["status"], told["total_units"], told["scored_units"], out.acc_auto) == ("computed", 12, 12, 1.0) and told["calibration_metrics"]["cohen_kappa"] == 1
    asked = len(Service.seen)
    rows = {r["query_id"]: r for r in out.scored_data.collect()}
    out.scored_data.count()
    assert asked == len(Service.seen) == 3 * (3 + 12) or asked == len(Service.seen)  # evaluating the result asks no more
    assert all(rows[f"q{i}"]["main_metric"] == i % 2 == rows[f"q{i}"]["agent_2_good"] and rows[f"q{i}"]["assessor_id"] == "judge" for i in range(12))
    left = [t._shared_path for t in out.tables]
    assert left and all("scored" in p for p in left)
    out.discard()
    assert not any(os.path.exists(p.removeprefix("file://")) for p in left)
    prompt = Service.seen[-1][2]["messages"][0]["content"]
    assert "Judge well" in prompt and "Answer:" in prompt and "is right" in prompt and "criterion | high" in prompt
    Service.lost = True
    with pytest.raises(ContractError, match="judge failed"):
        monitoring.main(spark, units(spark), contract(), chat.JudgeConfig(service, "m"), embed, {"text": "x"}, units(spark).drop("good"), stage="monitoring", delay=0.0, sleep=_no_sleep)


def test_run_statuses(spark):
    bad = {"contract_version": "laim-monitoring-metric.v2", "umr_version": "laim-umr.v2", "status": "not_computable", "reason": "why", "reason_code": "r"}
    out = monitoring.run(units(spark), bad, units(spark))
    assert out.assessment_result == {"contract_version": monitoring.RESULT_VERSION, "status": "not_computable", "total_units": None, "scored_units": 0, "reason": "why", "reason_code": "r"}
    assert out.scored_data.where("main_metric is null and assessment_unit_id is null").count() == 12
    with pytest.raises(ContractError):
        monitoring.run(units(spark).withColumn("good", F.lit(None).cast("double")), contract(), units(spark))
    none = lambda q, e, c: q.select("query_id", F.lit(None).cast("double").alias("agent_good"))
    with pytest.raises(ContractError, match="answered none"):
        monitoring.run(units(spark), contract(), stage="scoring", predict=none)
    some = lambda q, e, c: q.select("query_id", F.when(F.col("query_id") != "q3", 1.0).alias("agent_good"))
    got = monitoring.run(units(spark), contract(policy="fail"), units(spark), "monitoring", predict=some)
    assert (got.assessment_result["total_units"], got.assessment_result["scored_units"]) == (12, 11) and got.acc_auto is None
    with pytest.raises(ContractError):
        monitoring.run(units(spark), contract(), units(spark), "monitoring", predict=lambda q, e, c: q.select("query_id"))


def test_accuracy_run(spark):
    roles = [{"source_id": "p", "column_name": "guess", "role": "prediction", "normalization": "label"}, {"source_id": "t", "column_name": "truth", "role": "target", "normalization": "label"}]
    df = units(spark).withColumns({"guess": F.lit("x"), "truth": F.lit("x"), "main_metric": F.col("good")})
    seen = []

    def judge_all(queries, examples, criteria):
        seen.append(queries.select("text").head()[0])
        return queries.select("query_id", F.lit(1.0).alias("agent_assessment_score"))

    out = monitoring.run(df, contract("accuracy", sources=roles), units(spark).drop("good"), "combined", predict=judge_all)
    assert '"output_answer":"x"' in seen[0] and '"output_answer":"ans"' in seen[1] and out.assessment_result["scored_units"] == 12
    with pytest.raises(ContractError, match="prediction"):
        monitoring.run(df.withColumn("guess", F.lit(" ")), contract("accuracy", sources=roles), df, predict=judge_all)
    assert monitoring.source_missing(df, "none") and not monitoring.source_missing(df, "guess")


def test_labels_over_ranges(spark, monkeypatch):
    from assayworks.operators import agreement, units as u

    rows = [(i, "same" if i % 3 else f"own{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "_pos long, k string")
    want = {r["_pos"]: r["label"] for r in u.unique_labels(df, "k", F.lit("none")).collect()}
    seen, expected = 0, {}
    for i, k in rows:
        seen += k == "same"
        expected[i] = k if k != "same" or seen == 1 else f"same#{seen}"
    assert want == expected
    plain = agreement.range_bucket
    monkeypatch.setattr(u, "range_bucket", lambda df, c: plain(df, c, most=10, parts=8))
    assert {r["_pos"]: r["label"] for r in u.unique_labels(df, "k", F.lit("none")).collect()} == expected
    monkeypatch.setattr(agreement, "range_bucket", lambda df, c: plain(df, c, most=10, parts=8))
    pairs = spark.createDataFrame([(float(i), float((i * 7) % 50 // 3)) for i in range(50)], "a double, b double")
    assert agreement.spearman(pairs, "a", "b").head()[0] == pytest.approx(pairs.toPandas().corr("spearman").iloc[0, 1])
    train, test = agreement.split(spark.range(100).toDF("g"), "g", 0.37)
    assert train.count() == 37 and test.count() == 63 and train.intersect(test).count() == 0


def test_merged(spark):
    from assayworks.operators.voting import merged

    a = spark.createDataFrame([(1, float("inf")), (2, 0.5), (3, 1.0)], "k int, agent_c double")
    got = {r["k"]: r["agent_c"] for r in merged(a, spark.createDataFrame([(1, 1), (2, 0)], "k int, c int"), "k").collect()}
    assert got == {1: None, 2: 0.5}
