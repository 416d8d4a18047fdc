"""Command line: python -m vellumflow augment ... asks the model about the pages of books that have both
text and images, and stores the answers and each book's narration."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow import programs
from vellumflow.config import Config, find_project_root, load
from vellumflow.functions.names import base_name
from vellumflow.operators.pages import last_wins
from vellumflow.plans import runs, stages
from vellumflow.sources import files

WORKERS = 4


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vellumflow")
    parser.add_argument("stage", choices=["augment"])
    parser.add_argument("--book-dir", default="", help="folder of one book, with text/ and png/; else all documents of paths.input_dir")
    parser.add_argument("--model", default="", help="ask this model only")
    parser.add_argument("--workers", type=int, default=WORKERS, help="pages asked at a time; 0: settings.workers")
    parser.add_argument("--timeout", type=int, default=120, help="seconds for one request")
    parser.add_argument("--limit", type=int, default=0, help="pages of each book at the most; 0: all")
    return parser.parse_args(given)


def workers(asked: int, cfg: Config) -> int:
    return asked if asked > 0 else cfg.settings.workers if cfg.settings.workers > 0 else WORKERS


def _pages(spark: SparkSession, cfg: Config, book_dir: str) -> tuple[DataFrame, DataFrame]:
    """(texts, images) of the books that have both folders."""
    if book_dir:
        books = [(Path(book_dir).name, book_dir)]
    else:
        found = files.book_dirs(files.pdfs(spark, cfg.paths.input_dir), cfg.paths.output_dir)
        books = [(r["book"], r["dir"]) for r in found.orderBy("book").collect()]  # one row per document of a folder
    texts = images = None
    for book, folder in books:
        try:
            text = files.texts(spark, f"{folder}/text", book)
            image = files.contents(spark, files.images(spark, f"{folder}/png", book))
        except FileNotFoundError:
            continue
        image = last_wins(image, "content")
        texts, images = (text, image) if texts is None else (texts.union(text), images.union(image))
    if texts is None:
        raise FileNotFoundError("no book with text/ and png/")
    return texts.select("book", base_name(F.col("file_name")).alias("base"), "text"), images.select("book", "base", "content")


def augment(spark: SparkSession, cfg: Config, options: argparse.Namespace, run: runs.Run, ask=None) -> DataFrame:
    """(book, text) of every book; answers are stored as final_text, narrations as final_complete."""
    ask = ask or programs.asker(cfg, options.model, options.timeout)
    texts, images = _pages(spark, cfg, options.book_dir)
    told = run.store("final_text", stages.augment(texts, images, ask, cfg.prompts.extract_text.prompt.strip(), options.limit, workers(options.workers, cfg)))
    return run.store("final_complete", stages.narrate(told))


def main(given: list[str] | None = None) -> None:
    options = arguments(given)
    root, file = find_project_root(Path.cwd())
    cfg = load(file)
    spark = SparkSession.builder.appName("vellumflow").getOrCreate()
    out = options.book_dir or cfg.paths.output_dir
    run = runs.Run(spark, out, runs.logger(root / "logs" / "pipeline" / "augment.log"))
    augment(spark, cfg, options, run)
    run.report().show(truncate=False)


if __name__ == "__main__":
    main()
