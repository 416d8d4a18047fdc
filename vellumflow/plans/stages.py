"""The stages end to end. Each is a function from tables to a table; providers are arguments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow import providers
from vellumflow.config import Config
from vellumflow.functions.messages import build_prompt
from vellumflow.functions.names import base_name, chunk_file
from vellumflow.functions.text import clean_or_raw
from vellumflow.operators import assemble, audio, chunking, pages

NO_COUNT = "no number of pages"


def render(books: DataFrame, cfg: Config, count: Callable, draw: Callable, ink: Callable) -> DataFrame:
    """(book, base, file_name, content, error) of the pages of (book, pdf_path): counted, rendered,
    blank ones dropped. A page whose blankness cannot be told stays, as do one that cannot be rendered and,
    as a row without a name, a book whose pages cannot be counted, each with its error."""
    sized = providers.run(books, lambda: count, ["book", "pdf_path"], "pages", "int")
    failed = F.coalesce("error", F.when(F.col("pages").isNull(), NO_COUNT))
    sized = sized.select("book", "pdf_path", failed.alias("failed"), F.when(failed.isNull(), F.col("pages")).otherwise(1).alias("pages"))
    jobs = pages.page_jobs(sized).drop("pages").withColumn("file_name", F.when(F.col("failed").isNull(), F.col("file_name")))
    drawn = providers.run(jobs, lambda: providers.UnlessFailed(draw), ["book", "file_name"], "content", "binary", cfg.settings.workers).withColumn("base", base_name(F.col("file_name")))
    if not cfg.settings.skip_blank_pages:
        return drawn.select("book", "base", "file_name", "content", "error")
    rated = providers.run(drawn.select("book", "base", "file_name", "content", F.col("error").alias("failed")), lambda: providers.UnlessFailed(ink), ["book", "base", "file_name", "content", "failed"], "ink", "double")
    kept = pages.not_blank(rated, F.col("ink") < cfg.blank_detection.fast_non_white_threshold)
    return kept.select("book", "base", "file_name", "content", F.col("failed").alias("error"))


def recognise(images: DataFrame, done: DataFrame, ocr: Callable, workers: int = 0, keys: list[str] = pages.KEYS) -> DataFrame:
    """(book, base, text, error) of (book, base, content) without an output in done (book, base,
    length). The anti-join stands before the provider: nothing is pushed below it. With more keys, such as
    content_hash, an output counts only for equal ones, and the result has them too."""
    read = providers.run(pages.pending(images, done, keys), lambda: ocr, keys, workers=workers)
    return read.withColumn("text", clean_or_raw(F.col("text")))


def augment(texts: DataFrame, images: DataFrame, ask: Callable, prompt: str = "", limit: int = 0, workers: int = 0) -> DataFrame:
    """(book, base, doc_ord, text, error) of pages that have both a text and an image, in document order;
    the limit per book applies before the model is asked."""
    found = pages.in_order(pages.page_pairs(texts, images), limit)
    asked = found.select("book", "base", "doc_ord", build_prompt(F.col("text"), prompt).alias("prompt"), "content")
    return providers.run(asked, lambda: ask, ["book", "base", "doc_ord"], workers=workers)


def narrate(augmented: DataFrame) -> DataFrame:
    """(book, text) from stored results of augment()."""
    return assemble.concat_separated(augmented, "doc_ord")


def speak(narrations: DataFrame, done: DataFrame, speech: Callable, by_number: bool = False) -> DataFrame:
    """(book, chunk_no, file_name, content_hash, wav, error) of chunks not in done (book, chunk_no,
    content_hash, length). by_number takes a chunk as done whatever its text was."""
    work = chunking.chunks(narrations)
    keys = ["book", "chunk_no"] if by_number else ["book", "chunk_no", "content_hash"]
    spoken = providers.run(pages.pending(work, done, keys), lambda: speech, ["book", "chunk_no", "content_hash"], "wav", "binary")
    return spoken.withColumn("file_name", chunk_file(F.col("chunk_no")))


def encode(spoken: DataFrame, encoder: Callable, folder: str | None = None) -> DataFrame:
    """(book, mp3, error) of books of which no chunk failed: resampled, joined in order, encoded. A row holds
    2 GB at the most; books with more audio need a folder that all executors share, in which each is joined
    in a file, and the encoder gets its `path` in place of `wav`."""
    at_rate = spoken.withColumn("r", audio.resample(F.col("wav"))).select("book", "chunk_no", F.col("r.value").alias("wav"), F.coalesce("error", "r.error").alias("error"))
    whole = assemble.whole_groups(at_rate, "book")
    joined = audio.concat_to_files(whole, folder).select("book", "path") if folder else audio.concat_audio(whole)
    return providers.run(joined, lambda: encoder, ["book"], "mp3", "binary")
