"""The boundary to programs and services: rendering, recognition, language model, speech, encoding.

A provider takes one row's inputs and gives its value, or raises. run() applies one in Arrow batches;
failures become rows with an error and never fail a task. Filters do not pass below it: leave out done
work before, and store the result before it is read twice, since a second reading calls again.
"""

from __future__ import annotations

import os
import subprocess
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

MODELS = ("light", "standard", "large")
ROWS = 256  # whose inputs and answers are held at a time
ONE_THREAD = {"OMP_NUM_THREADS": "1", "OMP_THREAD_LIMIT": "1", "OPENBLAS_NUM_THREADS": "1", "MKL_NUM_THREADS": "1"}
Provider = Callable[[dict], object]


class Blank(Exception):
    """An answer without content."""


class Failed(Exception):
    """An error of an earlier step, reported as it is."""


@dataclass(frozen=True)
class UnlessFailed:
    """A provider that is not asked for rows in which an earlier step failed."""

    provider: Provider

    def __call__(self, row: dict) -> object:
        if row["failed"] is not None:
            raise Failed(row["failed"])
        return self.provider(row)


@dataclass(frozen=True)
class Retry:
    """Each model in turn, `attempts` times, with the same pause after every failure; the first answer
    that is not blank counts. All errors are tried again; the last one is reported."""

    call: Callable[[str, dict], str]
    models: tuple[str, ...] = MODELS
    attempts: int = 3
    pause_s: float = 30.0
    sleep: Callable[[float], None] = time.sleep

    def __call__(self, row: dict) -> str:
        last: Exception | None = None
        for model in self.models:
            for attempt in range(1, self.attempts + 1):
                try:
                    out = self.call(model, row)
                    if out and out.strip():
                        return out
                    raise Blank("blank answer")
                except Exception as e:
                    last = RuntimeError(f"model {model} attempt {attempt}/{self.attempts}: {e}")
                self.sleep(self.pause_s)
        raise last or RuntimeError("no model to ask")


@dataclass(frozen=True)
class Ocr:
    """A recogniser with a limit on time; after a time-out, and only then, once more with page mode 6.
    Blank output is an error."""

    recognise: Callable[[bytes, int], str]
    page_mode: int = 3

    def __call__(self, row: dict) -> str:
        try:
            out = self.recognise(row["content"], self.page_mode)
        except TimeoutError:
            out = self.recognise(row["content"], 6)
        if not out.strip():
            raise Blank("no text recognised")
        return out


@dataclass(frozen=True)
class Command:
    """An external program: arguments of a row, standard input and output, one thread, a time limit."""

    arguments: Callable[[dict], list[str]]
    stdin: Callable[[dict], bytes] = lambda row: b""
    timeout_s: float = 120.0
    env: dict = field(default_factory=dict)

    def __call__(self, row: dict) -> bytes:
        try:
            done = subprocess.run(self.arguments(row), input=self.stdin(row), capture_output=True, timeout=self.timeout_s, env=os.environ | ONE_THREAD | self.env, check=False)
        except subprocess.TimeoutExpired as e:
            raise TimeoutError(str(e)) from e
        if done.returncode:
            raise RuntimeError(f"exit code {done.returncode}: {done.stderr.decode(errors='replace')[-500:]}")
        return done.stdout


def api_key(variable: str) -> str:
    """The key in an environment variable, read where the call is made and sent as a header."""
    key = os.environ.get(variable, "").strip()
    if not key:
        raise LookupError(f"environment variable {variable} is empty")
    return key


def run(rows: DataFrame, make: Callable[[], Provider], keys: list[str], value: str = "text", kind: str = "string", workers: int = 0) -> DataFrame:
    """keys, `value` and `error` of each row. make() is called once per task: clients are made there.
    Rows are dealt evenly to `workers` tasks, so that no more calls run at a time; 0 leaves them as they lie."""
    types = dict(rows.dtypes)
    if workers > 0:
        rows = rows.repartition(workers)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for batch in (whole.iloc[at : at + ROWS] for whole in batches for at in range(0, len(whole), ROWS)):
            values, errors = [], []
            for row in batch.to_dict("records"):
                try:
                    values.append(provider(row))
                    errors.append(None)
                except Exception as e:
                    values.append(None)
                    errors.append(str(e) if isinstance(e, Failed) else f"{type(e).__name__}: {e}")
            yield batch[keys].assign(**{value: pd.Series(values, dtype=object, index=batch.index), "error": pd.Series(errors, dtype=object, index=batch.index)})

    return rows.mapInPandas(apply, ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"`{value}` {kind}", "error string"]))


# Deterministic stand-ins for tests and for machines without the programs.


def fake_render(row: dict) -> bytes:
    return f"page {row['page_no']} of {row['pdf_path']}".encode()


def fake_ink_ratio(row: dict) -> float:
    data = row["content"] or b""
    return sum(b != 255 for b in data) / len(data) if data else 0.0


def fake_recognise(content: bytes, page_mode: int) -> str:
    return bytes(content or b"").decode(errors="replace")


def fake_model(model: str, row: dict) -> str:
    return f"[{model}] {row['prompt']}"


def fake_speech(row: dict) -> bytes:
    """16-bit samples at 24 kHz, one per byte of the text."""
    from vellumflow.operators.audio import wav

    return wav(b"".join(int(256 * b - 32768).to_bytes(2, "little", signed=True) for b in row["chunk"].encode()), 24_000, 16)


def fake_encode(row: dict) -> bytes:
    import zlib

    return zlib.compress(bytes(row["wav"]))


def fake_decode(row: dict) -> bytes:
    import zlib

    return zlib.decompress(bytes(row["mp3"]))
