import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from vellumflow import __main__ as command
from vellumflow import programs, providers
from vellumflow.config import Config, GoogleApi, Paths, Settings, Tesseract
from vellumflow.functions import messages
from vellumflow.plans import runs, stages


def test_arguments():
    cfg = Config(settings=Settings(dpi=250), tesseract=Tesseract(language="deu", oem=1))
    assert programs.report_arguments("/a b.pdf") == ["pdfinfo", "/a b.pdf"]
    drawn = programs.render_arguments("/x.pdf", 7, cfg.render_dpi())
    assert drawn[0] == "ghostscript" and drawn[-3:] == ["-o", "-", "/x.pdf"]
    assert {"-sDEVICE=png16m", "-r250", "-dFirstPage=7", "-dLastPage=7", "-dTextAlphaBits=4", "-dGraphicsAlphaBits=4", "-dPDFFitPage", "-dBATCH", "-dNOPAUSE", "-q"} <= set(drawn)
    assert programs.recognise_arguments(cfg, 6) == ["tesseract", "stdin", "stdout", "-l", "deu", "--dpi", "250", "--oem", "1", "--psm", "6"]
    assert programs.recognise_arguments(Config(), 3)[3:7] == ["-l", "eng+equ", "--dpi", "300"]
    assert programs.blank_arguments("bin/detect", "/p.png", Config()) == ["bin/detect", "/p.png", "5", "0.005000"]
    spoken = programs.speech_arguments("M", "some text", "/w/chunk_0001.wav")
    assert spoken[:9] == ["f5-tts_infer-cli", "-m", "M", "-t", "some text", "-o", "/w", "-w", "chunk_0001.wav"] and "--remove_silence" in spoken and spoken[spoken.index("--ref_text") + 1] == ""
    told = programs.resample_arguments("/i.wav", "/o.wav")
    assert told[told.index("-ar") + 1] == "48000" and told[told.index("-c:a") + 1] == "pcm_s32le" and told[told.index("-rf64") + 1] == "auto" and told[-1] == "/o.wav"
    coded = programs.mp3_arguments()
    assert coded[coded.index("-c:a") + 1] == "libmp3lame" and coded[coded.index("-q:a") + 1] == "0" and coded[1:3] == ["-i", "pipe:0"] and coded[-1] == "pipe:1"


def test_page_report():
    assert programs.pages_of(b"Title: x\nPages:          12\nSize: 1\n") == 12
    for report in (b"", b"Pages: none\n", b"Pages: 0\n", b"No Pages: 3\n"):
        with pytest.raises(ValueError, match="no pages"):
            programs.pages_of(report)


def test_missing_programs_are_errors_of_their_rows(spark):
    rows = spark.createDataFrame([("b", "/b.pdf", 1)], "book string, pdf_path string, page_no int")
    out = providers.run(rows, lambda: programs.renderer(Config()), ["book"], "content", "binary").first()
    assert out["content"] is None and out["error"]


def test_replies_as_the_columns_have_them(spark):
    replies = [
        (200, '{"candidates": [{"content": {"parts": [{"text": "one"}, {"text": " "}, {"text": "two"}]}}]}'), (200, '{"candidates": []}'), (200, "{}"),
        (429, '{"error": {"message": "quota"}}'), (502, " not json "), (200, "not json"), (200, '{"error": {"message": "bad"}}'), (200, '{"candidates": [{}]}'),
    ]
    rows = spark.createDataFrame(replies, "status int, body string")
    for (status, body), r in zip(replies, rows.select(messages.parse_response(F.col("status"), F.col("body")).alias("r")).collect()):
        if r["r"]["error"] is None:
            assert programs.reply_text(status, body.encode()) == r["r"]["text"]
        else:
            with pytest.raises(RuntimeError) as e:
                programs.reply_text(status, body.encode())
            assert str(e.value) == r["r"]["error"]


def test_request_as_the_columns_have_it(spark):
    messages.unbroken_base64(spark)
    row = spark.createDataFrame([("prompt é", bytes(range(40)))], "p string, c binary")
    made = row.select(messages.build_request(F.col("p"), F.lit("image/png"), messages.encode_payload(F.col("c")))).first()[0]
    assert json.loads(programs.request_body("prompt é", "image/png", bytes(range(40)))) == json.loads(made)


def test_model_by_http(monkeypatch):
    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers["x-goog-api-key"], body["contents"][0]["parts"][0]["text"]))
            ok = "second" in self.path
            self.send_response(200 if ok else 503)
            self.end_headers()
            self.wfile.write(b'{"candidates": [{"content": {"parts": [{"text": "told"}]}}]}' if ok else b"busy")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        address = f"http://127.0.0.1:{server.server_port}/v1beta/models/{{model}}:generateContent"
        monkeypatch.setenv("SOME_KEY", " k ")
        ask = providers.Retry(programs.Model("SOME_KEY", address=address), ("first", "second"), 2, 0.0)
        assert ask({"prompt": "P", "content": b"x"}) == "told"
        assert asked == [("/v1beta/models/first:generateContent", "k", "P")] * 2 + [("/v1beta/models/second:generateContent", "k", "P")]
        with pytest.raises(RuntimeError, match="HTTP 503: busy"):
            programs.Model("SOME_KEY", address=address)("first", {"prompt": "P", "content": b""})
    finally:
        server.shutdown()
    monkeypatch.setenv("SOME_KEY", "")
    with pytest.raises(LookupError):
        programs.Model("SOME_KEY")("m", {"prompt": "", "content": b""})


def test_models_of_a_project():
    with pytest.raises(LookupError):
        programs.asker(Config())
    cfg = Config(google_api=GoogleApi("KEY", 5, 60))
    ask = programs.asker(cfg, "mine", 9.0)
    assert ask.models == ("mine",) and ask.attempts == 5 and ask.pause_s == 60 and ask.call.timeout_s == 9.0
    assert programs.asker(cfg).models == providers.MODELS and programs.endpoint("a b").endswith("/models/a%20b:generateContent")
    assert set(programs.all_providers(cfg)) == {"count", "draw", "ink", "ocr", "ask", "speech", "encode"}


def test_workers_bound_the_tasks(spark):
    rows = spark.range(0, 40, 1, 10).selectExpr("cast(id AS string) AS book")
    assert providers.run(rows, lambda: str, ["book"], workers=3).rdd.getNumPartitions() == 3
    assert command.workers(2, Config()) == 2 and command.workers(0, Config()) == 4 and command.workers(0, Config(settings=Settings(workers=7))) == 7
    none = spark.createDataFrame([], "book string, base string, length long")
    images = spark.createDataFrame([("b", f"p{i}", b"x") for i in range(9)], "book string, base string, content binary")
    assert stages.recognise(images, none, providers.Ocr(providers.fake_recognise), 2).count() == 9


def test_command_line(spark, tmp_path):
    options = command.arguments(["augment", "--book-dir", str(tmp_path / "b"), "--limit", "2", "--workers", "3", "--timeout", "7", "--model", "m"])
    assert (options.limit, options.workers, options.timeout, options.model) == (2, 3, 7, "m")
    for k in range(1, 4):
        for kind, suffix in (("text", "txt"), ("png", "png")):
            (tmp_path / "b" / kind).mkdir(parents=True, exist_ok=True)
            (tmp_path / "b" / kind / f"page_{k}.{suffix}").write_text(f"page {k}")
    run = runs.Run(spark, str(tmp_path / "out"))
    told = command.augment(spark, Config(), options, run, lambda row: f"told {row['base']}")
    assert [tuple(r) for r in told.collect()] == [("b", "told page_1\n\ntold page_2")]
    cfg = Config(paths=Paths(str(tmp_path / "pdf"), str(tmp_path)))
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "b.pdf").write_text("x")
    assert command.augment(spark, cfg, command.arguments(["augment"]), run, lambda row: row["base"]).first()["text"] == "page_1\n\npage_2\n\npage_3"
    with pytest.raises(FileNotFoundError):
        command.augment(spark, cfg, command.arguments(["augment", "--book-dir", str(tmp_path / "pdf")]), run, str)


def test_books_without_a_text_are_named(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path / "out"), runs.logger(tmp_path / "run.log"))
    books = spark.createDataFrame([("a",), ("b",)], "book string")
    told = spark.createDataFrame([("b", "t"), ("other", "u")], "book string, text string")
    assert [r["book"] for r in runs.with_text(run, books, told).collect()] == ["b"]
    assert "[WARNING] no complete text for 1 books: a" in (tmp_path / "run.log").read_text()
