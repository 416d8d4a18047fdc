"""A run from documents to audio: every stage's result is stored before the next one reads it, so that no
provider is asked twice, and each leaves a record. Recognised pages and spoken chunks are kept from run to
run, by name and hash of what they were made from; later runs ask for what is missing only."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.config import Config
from vellumflow.operators import assemble, chunking
from vellumflow.plans import stages

NAMED = 20  # books that a warning names at the most
PAGE = ["book", "base", "content_hash"]
CHUNK = ["book", "chunk_no", "content_hash"]
RECORD = "stage string, rows long, errors long, seconds double"


def logger(path: str | Path) -> logging.Logger:
    """Lines of "[LEVEL] message" to standard output and, appended, to a file."""
    made = logging.getLogger(f"vellumflow:{path}")
    if not made.handlers:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        for handler in (logging.StreamHandler(sys.stdout), logging.FileHandler(path, encoding="utf-8")):
            handler.setFormatter(logging.Formatter("[%(levelname)s] %(message)s"))
            made.addHandler(handler)
        made.setLevel(logging.INFO)
        made.propagate = False
    return made


@dataclass
class Run:
    """Stores results below a folder that driver and executors share."""

    spark: SparkSession
    folder: str
    log: logging.Logger = field(default_factory=lambda: logging.getLogger("vellumflow"))
    records: list[tuple] = field(default_factory=list)

    def store(self, name: str, result: DataFrame) -> DataFrame:
        """result as written to folder/name, which is replaced. Rows with an error stay in it, and only
        count: a run with failed items ends as any other."""
        began = time.monotonic()
        result.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        kept = self.spark.read.schema(result.schema).parquet(f"{self.folder}/{name}")
        bad = F.count_if(F.col("error").isNotNull()) if "error" in kept.columns else F.lit(0)
        rows, errors = kept.agg(F.count("*"), bad).first()
        self.records.append((name, rows, errors, time.monotonic() - began))
        (self.log.warning if errors else self.log.info)("%s: %d rows, %d errors", name, rows, errors)
        return kept

    def _read(self, name: str, schema) -> DataFrame:
        """What is stored as folder/name; no rows if nothing is."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else self.spark.createDataFrame([], schema)

    def resume(self, name: str, work: DataFrame, make: Callable[[DataFrame], DataFrame], keys: list[str], value: str) -> DataFrame:
        """Results of the work, by keys that are not null: those that earlier runs stored as folder/name and
        those that make(done), which leaves out what is in done (keys, length), has to add. Outputs with an
        error or without bytes are in the result, but not stored for later: the next run asks again. What
        work no longer has stays stored and is not in the result.

        What is made is written to folder/name-last first, in one piece, and added to folder/name then. A run
        that ends between the two, or amid the second, costs no calls: the next one adds what is missing."""
        began = time.monotonic()
        size = F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
        as_done = lambda rows: rows.select(*keys, size.alias("length"))
        good = F.col("error").isNull() & (size > 0)
        types = dict(work.dtypes)
        schema = make(self.spark.createDataFrame([], ", ".join(f"`{k}` {types[k]}" for k in keys) + ", length long")).schema
        add = lambda rows: rows.where(good).join(self._read(name, schema).select(*keys), keys, "left_anti").select(*schema.names).write.mode("append").parquet(f"{self.folder}/{name}")
        add(self._read(f"{name}-last", schema))
        make(as_done(self._read(name, schema))).write.mode("overwrite").parquet(f"{self.folder}/{name}-last")
        last = self._read(f"{name}-last", schema)
        add(last)
        wanted = self._read(name, schema).join(work.select(*keys), keys, "left_semi").select(*schema.names)
        result = wanted.union(last.where(~good))
        rows, errors = last.agg(F.count("*"), F.count_if(F.col("error").isNotNull())).first()
        self.records.append((name, rows, errors, time.monotonic() - began))
        (self.log.warning if errors else self.log.info)("%s: %d rows, %d errors", name, rows, errors)
        return result

    def report(self) -> DataFrame:
        """(stage, rows, errors, seconds) of what this run made and stored."""
        return self.spark.createDataFrame([(n, int(r), int(e), float(s)) for n, r, e, s in self.records], RECORD)


def books_to_audio(run: Run, books: DataFrame, cfg: Config, providers: dict[str, Callable], prompt: str = "", limit: int = 0) -> DataFrame:
    """(book, mp3, error) of (book, pdf_path), with providers for count, draw, ink, ocr, ask, speech and
    encode. ValueError if there is no book to work on."""
    if books.isEmpty():
        raise ValueError("no documents found")
    drawn = stages.render(books, cfg, providers["count"], providers["draw"], providers["ink"]).withColumn("content_hash", F.sha2("content", 256))
    images = run.store("png", drawn).where("error IS NULL").drop("error")
    workers = cfg.settings.workers and cfg.ocr_workers(1)
    texts = run.resume("text", images, lambda done: stages.recognise(images, done, providers["ocr"], workers, PAGE), PAGE, "text").where("error IS NULL").drop("error", "content_hash")
    told = run.store("final_text", stages.augment(texts, images, providers["ask"], prompt or cfg.prompts.extract_text.prompt.strip(), limit, cfg.settings.workers))
    narrations = run.store("final_complete", stages.narrate(told))
    return texts_to_audio(run, with_text(run, books, narrations), providers)


def with_text(run: Run, books: DataFrame, narrations: DataFrame) -> DataFrame:
    """Narrations of the books; books without one are left out, with a warning that names some of them."""
    missing = books.select("book").distinct().join(narrations, "book", "left_anti")
    named = [r["book"] for r in missing.orderBy("book").limit(NAMED).collect()]
    if named:
        run.log.warning("no complete text for %d books: %s", missing.count(), ", ".join(map(str, named)))
    return narrations.join(books.select("book"), "book", "left_semi")


def merged(run: Run, pages: DataFrame) -> DataFrame:
    """The other way to a book's text: its files (book, file_name, text) in byte order of their names,
    each followed by an empty line."""
    return run.store("complete", assemble.concat_terminated(pages))


def texts_to_audio(run: Run, narrations: DataFrame, providers: dict[str, Callable]) -> DataFrame:
    """(book, mp3, error) of (book, text)."""
    work = chunking.chunks(narrations).drop("chunk")
    spoken = run.resume("wav", work, lambda done: stages.speak(narrations, done, providers["speech"]), CHUNK, "wav")
    return run.store("mp3", stages.encode(spoken, providers["encode"]))
