import pytest

from vellumflow import config
from vellumflow.operators import assemble
from vellumflow.sources import files, sinks


def make(folder, **names):
    folder.mkdir(parents=True, exist_ok=True)
    for name, data in names.items():
        (folder / name).write_bytes(data)
    return str(folder)


def test_discovery(spark, tmp_path):
    at = make(tmp_path, **{"a.pdf": b"x", "b.PDF": b"x", "c.txt": b"x", "x[1].pdf": b"x", "_c.pdf": b"x", "My Book é.pdf": b"x"})
    (tmp_path / "dir.pdf").mkdir()
    make(tmp_path / "sub", **{"n.pdf": b"x"})
    assert {r["book"] for r in files.pdfs(spark, at).collect()} == {"a", "b", "x[1]", "_c", "My Book é"}
    assert {r["book"] for r in files.pdfs(spark, at, strict_suffix=True).collect()} == {"a", "b.PDF", "x[1]", "_c", "My Book é"}
    assert files.pdfs(spark, at, recursive=True).where("book = 'n'").count() == 1
    assert files.count_files(spark, at, ".txt") == 1
    dirs = files.book_dirs(files.pdfs(spark, at), "/out")
    assert ("b", "/out/b") in {tuple(r) for r in dirs.collect()}
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, at + "/none", (".pdf",))
    with pytest.raises(NotADirectoryError):
        files.ensure_dir(spark, at + "/a.pdf")


def test_order_of_names(spark, tmp_path):
    at = make(tmp_path, **{"page_0002.png": b"x", "page_0001.PNG": b"x", "note.txt": b"x"})
    assert [r["file_name"] for r in files.images(spark, at, "b", (".png",)).collect()] == ["page_0001.PNG", "page_0002.png"]
    wavs = make(tmp_path / "w", **{"chunk_0002.wav": b"x", "chunk_0001.WAV": b"x"})
    assert [(r["chunk_no"], r["file_name"]) for r in files.wavs(spark, wavs, "b").orderBy("chunk_no").collect()] == [(1, "chunk_0001.WAV"), (2, "chunk_0002.wav")]


def test_empty_and_invalid_texts(spark, tmp_path):
    at = make(tmp_path / "x[1] é", **{"a.txt": b"first", "b.txt": b"", "c.TXT": b"\xff!", "d.log": b"no", "_e.txt": b"hid"})
    rows = {r["file_name"]: r["text"] for r in files.texts(spark, at, "b").collect()}
    assert rows["a.txt"] == "first" and rows["b.txt"] == "" and rows["c.TXT"].endswith("!") and set(rows) == {"a.txt", "b.txt", "c.TXT", "_e.txt"}
    assert assemble.concat_terminated(files.texts(spark, at, "b")).first()["text"].startswith("hid\n\nfirst\n\n\n\n")


def test_many_hidden_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HIDDEN_BYTES", 10)
    at = make(tmp_path, **{f"_{i}.txt": b"abcd" * i for i in range(9)} | {".h.txt": b"dot", "p.txt": b"plain"})
    rows = {r["file_name"]: r["text"] for r in files.texts(spark, at, "b").collect()}
    assert rows == {f"_{i}.txt": "abcd" * i for i in range(9)} | {".h.txt": "dot", "p.txt": "plain"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b1", "a.txt", "x"), ("b2", "a.txt", "yy")], "book string, file_name string, text string")
    done = sinks.export_files(rows, str(tmp_path / "out")).collect()
    assert sorted(r["length"] for r in done) == [1, 2] and (tmp_path / "out/b2/a.txt").read_text() == "yy"
    table = str(tmp_path / "t")
    sinks.write_pages(rows, table)
    sinks.write_pages(rows.where("book = 'b1'").replace("x", "z"), table)
    assert {(r["book"], r["text"]) for r in spark.read.parquet(table).collect()} == {("b1", "z"), ("b2", "yy")}
    sinks.append_new(rows.where("book = 'b1'"), table)
    assert spark.read.parquet(table).count() == 3


def test_config(tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "project.toml").write_text('[project]\nname = "n"\nversion = "1"\n[paths]\ninput_dir = "i"\noutput_dir = "o"\n[settings]\nworkers = 90\ndpi = 0\n[google_api]\nmax_retries = 0\n[unknown]\nx = 1\n')
    folder, path = config.find_project_root(tmp_path / "a/b")
    cfg = config.load(path)
    assert folder == tmp_path and cfg.project.name == "n" and cfg.paths.input_dir == "i" and cfg.render_dpi() == 200 and cfg.ocr_dpi() == 300
    assert cfg.ocr_workers(4) == 64 and cfg.google_api.max_retries == 3 and not cfg.settings.skip_blank_pages
    cfg.require_dirs()
    with pytest.raises(ValueError):
        config.Config().require_dirs()
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "none.toml")
