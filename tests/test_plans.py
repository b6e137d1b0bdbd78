import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.messages import CLEAN_SYSTEM
from corpusloom.operators import features
from corpusloom.plans import cleaning, cli, taxonomy
from corpusloom.plans.providers import ChatNamer, FileTokenizer, HttpEmbedder, StubNamer, http_chat
from corpusloom.sources import files, workbook
from corpusloom.streaming.append import append_cleaned

HEADER = ["instance", "ticketnumber", "title", "description", "issue_type", "sub_issue_type", "hours"]


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    rows = [("a", 1.0, "x < y & z\n2", None), ("b", 2.5, " sp ", "_x000D_")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_row long, s string, n double, t string, u string")
    workbook.write_workbook(df, path)
    got = workbook.read_workbook(spark, path, names={"s": "name"})
    assert got.columns == ["name", "n", "t", "u", "_row"]
    assert [tuple(r) for r in got.orderBy("_row").collect()] == [("a", "1.0", "x < y & z\n2", None, 0), ("b", "2.5", " sp ", "_x000D_", 1)]
    with pytest.raises(Exception, match="no sheet"):
        workbook.read_workbook(spark, path, sheet="Other").count()
    some = spark.read.format("workbook").schema("u string, absent string, _row long").load(path)
    assert [tuple(r) for r in some.orderBy("_row").collect()] == [(None, None, 0), ("_x000D_", None, 1)]


def test_records_and_caches(spark, tmp_path):
    rec = spark.createDataFrame([("a::1", "a", "t", "", "", "", "", 1.5, 2)], files.RECORDS)
    files.write_records(rec, str(tmp_path / "r"))
    assert files.read_records(spark, str(tmp_path / "r")).collect() == rec.collect()
    broken = tmp_path / "b.json"
    broken.write_text("{nonsense\n")
    with pytest.raises(Exception):  # noqa: B017, PT011
        files.read_records(spark, str(broken)).collect()
    cache = tmp_path / "c"
    cache.mkdir()
    (cache / "x.json").write_text('{"id": "1", "text": "a"}\nnot json\n\n{"id": "1", "text": "b"}\n{"text": "no id"}\n{"id": "2"}\n')
    from corpusloom.operators.requests import latest

    got = latest(files.read_cache(spark, str(cache)))
    assert {tuple(r) for r in got.collect()} == {("1", "b"), ("2", "")}
    new = spark.createDataFrame([("1", "z"), ("3", "c"), ("3", "c")], "id string, text string")
    for _ in range(2):
        files.append_new(new, files.read_cache(spark, str(cache)), str(cache))
    assert sorted(r.id for r in files.read_cache(spark, str(cache)).collect()) == ["1", "1", "2", "3"]
    assert files.read_map(str(tmp_path / "none.json")) == {}
    with pytest.raises(FileNotFoundError):
        files.read_document(str(tmp_path / "none.json"))


def test_clean_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a  b", "keep  me"), (2, "ok", None), (3, None, "x")], "i long, description string, other string")
    out, seen = cleaning.clean_table(df, {**cleaning.TARGETS["tickets"], "absent": lambda c: c})
    out.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 3, "cells_cleaned": 1}
    assert out.columns == df.columns and [tuple(r) for r in out.orderBy("i").collect()] == [(1, "a b", "keep  me"), (2, "ok", None), (3, "", "x")]


def test_clean_workbook_keeps_all_else(spark, tmp_path):
    a, b = str(tmp_path / "a.xlsx"), str(tmp_path / "b.xlsx")
    df = spark.createDataFrame([(0, "x  y<br>", 1.5, " as is "), (1, None, 2.0, None)], "_row long, `all[description]` string, hours double, other string")
    workbook.write_workbook(df, a)
    got = cleaning.clean_workbook(spark, a, b, "tickets", names={"all[description]": "description"}, numbers=("hours",))
    assert (got["rows"], got["cells_cleaned"]) == (2, 1)
    with open(b, "rb") as f:
        assert list(workbook.read_rows(f.read(), "Export")) == [["all[description]", "hours", "other"], ["x y", "1.5", " as is "], ["", "2.0", None]]
    with open(a, "rb") as f, pytest.raises(ValueError, match="no sheet"):
        list(workbook.read_rows(f.read(), "Other"))


def test_load_env(tmp_path, monkeypatch):
    monkeypatch.setenv("CL_A", "kept")
    for name in ("CL_B", "CL_C"):
        monkeypatch.delenv(name, raising=False)
    (tmp_path / ".env").write_text("# note\nCL_A=new\nexport CL_B=\"two words\"\nCL_C= x=y \nnonsense\n")
    assert files.load_env(str(tmp_path / ".env")) == {"CL_A": "kept", "CL_B": "two words", "CL_C": "x=y"}
    assert files.load_env(str(tmp_path / "none")) == {}


class Service:
    def __init__(self):
        self.sent, self.ready = {}, False

    def submit(self, requests):
        self.sent = dict(requests)
        return "b1"

    def results(self, batch_id):
        return [(k, json.dumps([{"id": i, "text": f"{k}-{i}"} for i in range(m.count("--- TICKET"))])) for k, m in self.sent.items()] if self.ready else None


def test_cleaning_by_a_service(spark, tmp_path):
    tickets = spark.createDataFrame([(i, "a", str(i), "x" * (39 if i == 3 else 60)) for i in range(30)], "_row long, instance string, ticketnumber string, description string")
    service, paths = Service(), (str(tmp_path / "cache"), str(tmp_path / "manifest.json"))
    run = lambda **o: cleaning.clean_with_service(spark, tickets, service, *paths, **o)
    assert run(dry_run=True) == {"requests": 3, "input_tokens": 435} and not service.sent
    assert run() == {"submitted": 3, "batch_id": "b1"}
    assert run() == {"waiting": "b1"}
    assert run(dry_run=True)["requests"] == 3
    service.ready = True
    assert run() == {"written": 29} and run() == {"submitted": 0}
    files.write_document({}, paths[1])
    assert run(force_new=True) == {"submitted": 0} and not (tmp_path / "manifest.json").exists()
    twin, seen = cleaning.ticket_twin(tickets, files.read_cache(spark, paths[0]).select("id", "text"))
    twin.write.parquet(str(tmp_path / "twin"))
    assert seen.get == {"rows": 30, "llm": 29, "fallback": 1}


def test_chat_namer_tries_again():
    said = iter(["not json", RuntimeError("429 slow down"), '```json\n{"title": " A ", "coherent": "false"}\n```', '[{"id": "1", "category": " C "}, {"id": null}]', '{"coherence": 7}'])

    def send(system, message):
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x, 3, 2

    waits = []
    namer = ChatNamer(send, pause=waits.append)
    assert namer.name_cluster("m", 4) == {"title": "A", "description": "", "coherent": False, "coherence_note": ""}
    assert len(waits) == 2 and waits[1] > waits[0]
    assert namer.assign_categories([{"id": 1}, {"id": 2}], "m") == {1: "C", 2: "Other"} and namer.assign_categories([], "m") == {}
    assert namer.judge("m") == {"coherence": 7.0, "distinctness": 0.0, "overall": 0.0, "notes": ""}
    assert namer.usage == {"calls": 4, "input_tokens": 12, "output_tokens": 8}
    with pytest.raises(RuntimeError, match="no answer"):
        ChatNamer(lambda s, m: ("x", 0, 0), tries=2, pause=waits.append).judge("m")
    with pytest.raises(PermissionError):
        ChatNamer(lambda s, m: (_ for _ in ()).throw(PermissionError()), pause=waits.append).judge("m")


def test_finalize_gates_before_it_writes(spark, tmp_path):
    cluster = {"cluster_id": 0, "title": "Reset", "description": "mail pat@example.com", "category": "Access", "qualifies": True, "examples": ["secret"], "hours": 1.0}
    small = {**cluster, "cluster_id": 1, "title": "Small", "qualifies": False}
    artifact = {"combo": "all_equal", "weights": {}, "k": 2, "coverage": {}, "llm_score": {}, "clusters": [cluster, small]}
    got = taxonomy.finalize(spark, artifact, {}, str(tmp_path / "out"))
    assert (tmp_path / "out/taxonomy.md").read_text().splitlines() == ["Reset | Access | mail [EMAIL]", " | ".join(taxonomy.OTHER)]
    assert got["n_workflows"] == 2 and got["redactions"] == 1 and "pat@" not in (tmp_path / "out/clusters.jsonl").read_text()
    artifact["clusters"][0]["title"] = "of a@b.example"
    with pytest.raises(ValueError, match="personal data"):
        taxonomy.finalize(spark, artifact, {}, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_summary_order():
    line = lambda n, c, o: {"combo": n, "weights": {}, "k": 1, "coverage": {"coverage": c, "n_named_clusters": 1}, "llm_score": {"coherence": 1, "distinctness": 1, "overall": o}, "best_silhouette": 0}
    assert [s["combo"] for s in taxonomy.summary([line("a", 0.1, 9), line("b", 0.5, 1), line("c", 0.5, 2), line("d", 0.5, 2)])] == ["c", "d", "b", "a"]


def test_all_stages_from_workbooks(spark, tmp_path):
    kinds = [("Printer", "Storing"), ("VPN", "Vraag"), ("Mail", "Wijziging")]
    tickets = [(i, "a", str(i), f"{kinds[i % 3][0]} {i}", f"about {kinds[i % 3][0]}  <b>x</b>", kinds[i % 3][1], kinds[i % 3][0], 1.0 + i % 4) for i in range(36)]
    entries = [(i, "a", str(i), f"2024-01-{1 + i % 28:02}", f"did {i % 3}", None, 1.0) for i in range(30)]
    t, e = str(tmp_path / "t.xlsx"), str(tmp_path / "e.xlsx")
    workbook.write_workbook(spark.createDataFrame(tickets, "_row long, " + ", ".join(f"{h} {'double' if h == 'hours' else 'string'}" for h in HEADER)), t)
    workbook.write_workbook(spark.createDataFrame(entries, "_row long, instance string, ticketnumber string, startdatetime string, summarynotes string, internalnotes string, hours double"), e)
    run = lambda *a: cli.main(["--tickets", t, "--entries", e, "--out", str(tmp_path / "r"), "--cleaned", str(tmp_path / "c"), "--dry-run", *a])
    old = settings.COMBOS
    run("--stage", "clean")
    assert not (tmp_path / "c").exists()
    settings.COMBOS = {k: old[k] for k in ("labels_only", "all_equal")}
    try:
        run("--stage", "all", "--fixed-k", "3", "--starts", "1", "--select", "labels_only")
    finally:
        settings.COMBOS = old
    assert files.read_document(str(tmp_path / "r/records_meta.json"))["kept"] == 36
    assert files.read_document(str(tmp_path / "r/stability.json"))["mean_ari"] == 1.0
    assert len(files.read_document(str(tmp_path / "r/sweep_summary.json"))["combos"]) == 2
    assert (tmp_path / "r/taxonomy.md").exists()
    with pytest.raises(SystemExit):
        run("--stage", "finalize")
    (tmp_path / "r/stability.json").unlink()
    run("--stage", "stability", "--select", "labels_only", "--starts", "1")
    assert files.read_document(str(tmp_path / "r/stability.json"))["n_runs"] == 4
    with pytest.raises(SystemExit, match="dry-run"):
        cli.main(["--tickets", t, "--entries", e, "--out", str(tmp_path / "r"), "--stage", "sweep"])


def test_descriptions_through_a_queue(spark, tmp_path):
    rows = [(i, "a", str(i), f"the printer of room {i} prints nothing at all since monday <b>") for i in range(5)]
    t, e, c, q = (str(tmp_path / n) for n in ("t.parquet", "e.parquet", "c", "q"))
    spark.createDataFrame(rows, "_row long, instance string, ticketnumber string, description string").write.parquet(t)
    spark.createDataFrame([(0, "a", "1", "did <br>", None)], "_row long, instance string, ticketnumber string, summarynotes string, internalnotes string").write.parquet(e)
    run = lambda *a: cli.main(["--tickets", t, "--entries", e, "--cleaned", c, "--stage", "clean", "--queue", q, *a])
    with pytest.raises(SystemExit, match="in flight"):
        run("--collect")
    run("--sample", "3", "--batch-size", "2", "--char-limit", "20", "--submit-only")
    (batch,) = (tmp_path / "q").iterdir()
    sent = [json.loads(line) for line in batch.read_text().splitlines()]
    assert [s["message"].count("TICKET") for s in sent] == [2, 1] and all(s["system"] == CLEAN_SYSTEM and "truncated" in s["message"] for s in sent)
    answers = [{"custom_id": s["custom_id"], "answer": json.dumps([{"id": 0, "text": "by model"}])} for s in sent]
    (tmp_path / "q" / batch.name.replace("requests", "answers")).write_text("\n".join(json.dumps(x) for x in answers))
    run("--collect", "--poll-interval", "0")
    twin = {r.ticketnumber: r.description for r in spark.read.parquet(f"{c}/t.cleaned.parquet").collect()}
    assert [twin[k] == "by model" for k in "01234"] == [True, False, True, False, False]
    assert spark.read.parquet(f"{c}/e.cleaned.parquet").first().summarynotes == "did"


def test_given_paths_win_over_twins(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert cli.source("tickets", None, "c", False) == "data/tickets.xlsx"
    (tmp_path / "c/tickets.cleaned.parquet").mkdir(parents=True)
    assert cli.source("tickets", None, "c", False) == "c/tickets.cleaned.parquet"
    assert cli.source("tickets", None, "c", True) == "data/tickets.xlsx"
    assert cli.source("tickets", "x/tickets.xlsx", "c", False) == "x/tickets.xlsx"


def test_inputs_cut_by_tokens(spark):
    import public_tokenizers

    texts = ["a b " * 6000, "short", None]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "ticket_id string, notes string")
    tokenizer = FileTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.ticket_id: r for r in features.inputs(rows, "notes", tokenizer).collect()}
    assert len(tokenizer.encode(got["0"].text)) <= settings.INPUT_TOKENS < len(tokenizer.encode(texts[0]))
    assert texts[0].startswith(got["0"].text) and (got["1"].text, got["1"].size, got["2"].text) == ("short", 2, "")


def test_services_over_http():
    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            code, said = 200, {}
            if self.headers["Authorization"] != "Bearer k":
                code = 401
            elif self.path.endswith("/embeddings") and len(body["input"]) > 2:
                code, said = 400, {"error": "max_tokens_per_request"}
            elif self.path.endswith("/embeddings"):
                said = {"data": [{"index": i, "embedding": [len(t), body["dimensions"]]} for i, t in reversed(list(enumerate(body["input"])))]}
            else:
                said = {"choices": [{"message": {"content": '{"overall": 3}'}}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}}
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(said).encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1"
    try:
        embedder = HttpEmbedder(url, "k", "m", width=2)
        texts = ["a", "bb", "ccc", "dddd", "e"]
        assert [v.tolist() for v in features.embed_with_split(embedder, texts, texts)] == [[len(t), 2] for t in texts]
        namer = ChatNamer(http_chat(url, "k", "m"))
        assert namer.judge("x")["overall"] == 3.0 and namer.usage == {"calls": 1, "input_tokens": 7, "output_tokens": 2}
        with pytest.raises(PermissionError):
            ChatNamer(http_chat(url, "other", "m")).judge("x")
    finally:
        server.shutdown()


def test_stream_appends_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(2):
        spark.createDataFrame([(str(i), f"text {i}<br>") for i in range(3 + n)], "id string, text string").coalesce(1).write.mode("append").json(str(source))
        arriving = spark.readStream.schema("id string, text string").json(str(source))
        append_cleaned(arriving, str(tmp_path / "cache"), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = files.read_cache(spark, str(tmp_path / "cache")).select("id", F.trim("text")).collect()
    assert sorted(tuple(r) for r in got) == [(str(i), f"text {i}") for i in range(4)]
    assert StubNamer().judge("m")["overall"] == 5.0
