import struct
import uuid

import pytest

from vellumflow import providers
from vellumflow.config import BlankDetection, Config, Settings
from vellumflow.operators import audio
from vellumflow.plans import runs, stages
from vellumflow.streaming.resume import process_new


def test_retry():
    calls, pauses = [], []

    def call(model, row):
        calls.append(model)
        if len(calls) < 5:
            raise OSError("down")
        return "" if len(calls) == 5 else "ok"

    ask = providers.Retry(call, ("a", "b", "c"), 2, 7.0, pauses.append)
    assert ask({}) == "ok" and calls == ["a", "a", "b", "b", "c", "c"] and pauses == [7.0] * 5
    with pytest.raises(RuntimeError, match="model b attempt 1/1: blank answer"):
        providers.Retry(lambda m, r: " ", ("a", "b"), 1, 0.0, pauses.append)({})


def test_ocr_second_try_only_after_time_out():
    modes = []

    def slow(content, mode):
        modes.append(mode)
        if mode == 3:
            raise TimeoutError
        return "text"

    assert providers.Ocr(slow)({"content": b""}) == "text" and modes == [3, 6]
    with pytest.raises(providers.Blank):
        providers.Ocr(lambda c, m: " \n")({"content": b""})


def test_command():
    cat = providers.Command(lambda row: ["cat"], lambda row: row["x"])
    assert cat({"x": b"in"}) == b"in"
    with pytest.raises(RuntimeError, match="exit code"):
        providers.Command(lambda row: ["false"])({})
    with pytest.raises(TimeoutError):
        providers.Command(lambda row: ["sleep", "5"], timeout_s=0.1)({})


def test_stages(spark, tmp_path):
    cfg = Config(settings=Settings(skip_blank_pages=True), blank_detection=BlankDetection())
    books = spark.createDataFrame([("b", "/b.pdf"), ("none", "/n.pdf")], "book string, pdf_path string")

    def count(row):
        return 12 if row["book"] == "b" else 0

    def draw(row):
        if row["page_no"] == 5:
            raise OSError("cannot draw")
        return b"\xff" * 400 if row["page_no"] == 3 else f"page no {row['page_no']}".encode()

    def ink(row):
        if row["base"] == "page_0004":
            raise OSError("cannot tell")
        return providers.fake_ink_ratio(row) if row["content"] else 1.0

    drawn = stages.render(books, cfg, count, draw, ink).cache()
    assert {r["base"] for r in drawn.collect()} == {f"page_{i:04d}" for i in range(1, 13) if i != 3}
    assert [r["error"] for r in drawn.where("base = 'page_0005'").collect()] == ["OSError: cannot draw"]
    good = drawn.where("error IS NULL").drop("error")
    done = spark.createDataFrame([("b", "page_0001", 4), ("b", "page_0002", 0)], "book string, base string, length long")
    read = stages.recognise(good, done, providers.Ocr(providers.fake_recognise)).cache()
    assert read.count() == 9 and read.where("base = 'page_0002'").first()["text"] == "page no 2"
    told = stages.augment(read.drop("error"), good, providers.Retry(providers.fake_model, pause_s=0.0), "P", 3).cache()
    assert [r["base"] for r in told.orderBy("doc_ord").collect()] == ["page_0002", "page_0004", "page_0006"]
    narrated = stages.narrate(told)
    assert narrated.first()["text"].count("[light] P") == 3
    none = spark.createDataFrame([], "book string, chunk_no int, content_hash string, length long")
    spoken = stages.speak(narrated, none, providers.fake_speech).cache()
    first = spoken.orderBy("chunk_no").first()
    assert first["file_name"] == "chunk_0001.wav"
    again = spoken.selectExpr("book", "chunk_no", "content_hash", "length(wav) AS length")
    assert stages.speak(narrated, again, providers.fake_speech).count() == 0
    stale = again.selectExpr("book", "chunk_no", "'old' AS content_hash", "length")
    assert stages.speak(narrated, stale, providers.fake_speech).count() == spoken.count()
    assert stages.speak(narrated, stale, providers.fake_speech, by_number=True).count() == 0
    coded = stages.encode(spoken, providers.fake_encode).collect()
    assert len(coded) == 1 and coded[0]["error"] is None
    (tmp_path / "audio").mkdir()
    by_file = stages.encode(spoken, lambda row: providers.fake_encode({"wav": open(row["path"], "rb").read()}), str(tmp_path / "audio")).collect()
    assert providers.fake_decode(by_file[0].asDict()) == providers.fake_decode(coded[0].asDict())
    bad = spoken.selectExpr("book", "chunk_no", "if(chunk_no = 1, cast('x' AS binary), wav) AS wav", "error")
    assert stages.encode(bad, providers.fake_encode).count() == 0


def test_run(spark, tmp_path):
    books = spark.createDataFrame([("b", "/b.pdf"), ("c", "/c.pdf")], "book string, pdf_path string")
    made = {
        "count": lambda row: 3, "draw": providers.fake_render, "ink": providers.fake_ink_ratio, "ocr": providers.Ocr(providers.fake_recognise),
        "ask": providers.Retry(providers.fake_model, pause_s=0.0), "speech": providers.fake_speech, "encode": providers.fake_encode,
    }
    run = runs.Run(spark, str(tmp_path / "out"), runs.logger(tmp_path / "log/run.log"))
    assert runs.books_to_audio(run, books, Config(), made, "P").where("error IS NULL").count() == 2
    assert [(r["stage"], r["rows"], r["errors"]) for r in run.report().collect()][:4] == [("png", 6, 0), ("text", 6, 0), ("final_text", 6, 0), ("final_complete", 2, 0)]
    assert "[INFO] mp3: 2 rows, 0 errors" in (tmp_path / "log/run.log").read_text()
    pages = spark.createDataFrame([("b", "a.txt", "x"), ("b", "b.txt", "y")], "book string, file_name string, text string")
    assert runs.merged(run, pages).first()["text"] == "x\n\ny\n\n"
    with pytest.raises(ValueError, match="no documents"):
        runs.books_to_audio(run, books.limit(0), Config(), made)


def test_second_run_asks_for_what_is_missing(spark, tmp_path):
    """No calls for what is stored; failed and empty outputs and changed ones are asked for again."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def noting(name, provider):
        def call(row):
            (calls / f"{name}-{uuid.uuid4().hex}").touch()
            return provider(row)

        return call

    def asked():
        names = [p.name.split("-")[0] for p in calls.iterdir()]
        [p.unlink() for p in calls.iterdir()]
        return names.count("ocr"), names.count("speech")

    def ocr(row, broken):
        text = bytes(row["content"]).decode()
        if broken and text.startswith("page 2"):
            raise OSError("no answer")
        return "" if broken and text.startswith("page 3") else text

    def go(broken=False, path="/b.pdf"):
        books = spark.createDataFrame([("b", path)], "book string, pdf_path string")
        made = {
            "count": lambda row: 3, "draw": providers.fake_render, "ink": providers.fake_ink_ratio, "ocr": noting("ocr", lambda row: ocr(row, broken)),
            "ask": providers.Retry(providers.fake_model, pause_s=0.0), "speech": noting("speech", providers.fake_speech), "encode": providers.fake_encode,
        }
        run = runs.Run(spark, str(tmp_path / "out"))
        out = runs.books_to_audio(run, books, Config(), made, "P")
        return out.where("error IS NULL").count(), {r["stage"]: r["errors"] for r in run.report().collect()}

    assert go(broken=True) == (1, {"png": 0, "text": 1, "final_text": 0, "final_complete": 0, "wav": 0, "mp3": 0})
    first = asked()
    assert first[0] == 3
    assert go()[1]["text"] == 0 and asked()[0] == 2
    assert go()[0] == 1 and asked() == (0, 0)
    assert go(path="/c.pdf")[0] == 1 and asked()[0] == 3


def test_run_that_broke_off_is_taken_up(spark, tmp_path):
    work = spark.createDataFrame([("b", i, "h", str(i)) for i in range(4)], "book string, n int, content_hash string, content string")
    keys, calls = ["book", "n", "content_hash"], tmp_path / "calls"
    calls.mkdir()

    def provider(row):
        (calls / uuid.uuid4().hex).touch()
        return row["content"]

    made = lambda done: providers.run(work.join(done.where("length > 0"), keys, "left_anti"), lambda: provider, keys)
    run = runs.Run(spark, str(tmp_path / "out"))
    assert run.resume("t", work, made, keys, "text").count() == 4 and len(list(calls.iterdir())) == 4
    (tmp_path / "out" / "t").rename(tmp_path / "lost")  # results were made, but not added
    assert sorted(r["text"] for r in run.resume("t", work, made, keys, "text").collect()) == ["0", "1", "2", "3"]
    assert len(list(calls.iterdir())) == 4
    assert run.resume("t", work.where("n < 2"), made, keys, "text").count() == 2


def test_failed_books_stay_in_the_result(spark):
    def count(row):
        if row["book"] == "bad":
            raise OSError("broken file")
        return {"none": None, "empty": 0}.get(row["book"], 2)

    def draw(row):
        if row["page_no"] == 2:
            raise OSError("no page")
        return providers.fake_render(row)

    books = spark.createDataFrame([(b, f"/{b}.pdf") for b in ("good", "bad", "none", "empty")], "book string, pdf_path string").coalesce(1)
    out = stages.render(books, Config(), count, draw, providers.fake_ink_ratio)
    found = sorted((r["book"], r["base"] or "", r["content"] is None, r["error"] or "") for r in out.collect())
    assert found == [("bad", "", True, "OSError: broken file"), ("good", "page_0001", False, ""), ("good", "page_0002", True, "OSError: no page"), ("none", "", True, stages.NO_COUNT)]


def test_audio(spark, tmp_path):
    wav = audio.wav(struct.pack("<4h", 0, 100, -100, 32767), 24_000, 16)
    rate, bits, channels, pcm = audio.read_wav(audio.resample_one(wav))
    assert (rate, bits, channels, len(pcm)) == (48_000, 32, 1, 32) and struct.unpack("<8i", pcm)[:3] == (0, 50 << 16, 100 << 16)
    rows = spark.createDataFrame([("b", 2, audio.wav(b"cc", 8000, 16)), ("b", 1, audio.wav(b"aabb", 8000, 16))], "book string, chunk_no int, wav binary")
    assert audio.read_wav(audio.concat_audio(rows).first()["wav"])[3] == b"aabbcc"
    done = audio.concat_to_files(rows, str(tmp_path)).first()
    assert audio.read_wav(open(done["path"], "rb").read()) == (8000, 16, 1, b"aabbcc") and done["bytes"] == 6


def test_resume(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "x long"
    run = lambda: process_new(spark, source, schema, lambda d: d.selectExpr("x * 2 AS y"), str(tmp_path / "out"), str(tmp_path / "log"))
    spark.range(3).selectExpr("id AS x").write.parquet(source)
    assert sorted(r["y"] for r in run().collect()) == [0, 2, 4]
    assert run().count() == 3
    spark.range(10, 12).selectExpr("id AS x").write.mode("append").parquet(source)
    assert sorted(r["y"] for r in run().collect()) == [0, 2, 4, 20, 22]
