"""The programs and the service behind the providers: their arguments, and what they answer.

Programs read standard input and write standard output where they can; the speech program, which only
writes files, gets a folder of its own for the one call. The programs need not be there to build the
arguments.
"""

from __future__ import annotations

import json
import re
import subprocess
import tempfile
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from vellumflow.config import Config
from vellumflow.functions import messages
from vellumflow.providers import Blank, Command, Ocr, Retry, api_key

# Options of the programs and the service's address, on which their results depend.
ENDPOINT = "https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent"
RENDER = ("-q", "-dNOPAUSE", "-dBATCH", "-sDEVICE=png16m", "-dTextAlphaBits=4", "-dGraphicsAlphaBits=4", "-dDownScaleFactor=1", "-dPDFFitPage")
SPEECH = ("--remove_silence", "--load_vocoder_from_local", "--ref_text", "", "--no_legacy_text")
RESAMPLE = ("-ar", "48000", "-ac", "1", "-c:a", "pcm_s32le", "-af", "aresample=async=1:first_pts=0")
MP3 = ("-c:a", "libmp3lame", "-q:a", "0")
QUIET = ("-hide_banner", "-loglevel", "error", "-y")


def report_arguments(pdf_path: str) -> list[str]:
    return ["pdfinfo", pdf_path]


def pages_of(report: bytes) -> int:
    """Pages told by a document report; ValueError unless there are some."""
    told = re.findall(rb"^Pages:\s+([0-9]+)\s*$", report, re.MULTILINE)
    if not told or int(told[-1]) < 1:
        raise ValueError("the report tells no pages")
    return int(told[-1])


def render_arguments(pdf_path: str, page_no: int, dpi: int, out: str = "-") -> list[str]:
    """One page as an image, to standard output unless told otherwise."""
    return ["ghostscript", *RENDER, f"-r{dpi}", f"-dFirstPage={page_no}", f"-dLastPage={page_no}", "-o", out, pdf_path]


def recognise_arguments(cfg: Config, page_mode: int) -> list[str]:
    t = cfg.tesseract
    return ["tesseract", "stdin", "stdout", "-l", t.language.strip() or "eng+equ", "--dpi", str(cfg.ocr_dpi()), "--oem", str(t.oem), "--psm", str(page_mode)]


def blank_arguments(program: str, path: str, cfg: Config) -> list[str]:
    found = cfg.blank_detection
    return [program, path, str(found.fast_fuzz_percent), f"{found.fast_non_white_threshold:.6f}"]


def speech_arguments(model: str, text: str, out: str | Path) -> list[str]:
    out = Path(out)
    return ["f5-tts_infer-cli", "-m", model, "-t", text, "-o", str(out.parent), "-w", out.name, *SPEECH]


def resample_arguments(source: str = "pipe:0", out: str = "pipe:1") -> list[str]:
    return ["ffmpeg", "-i", source, *RESAMPLE, *(("-f", "wav") if out == "pipe:1" else ("-rf64", "auto")), *QUIET, out]


def mp3_arguments(source: str = "pipe:0", out: str = "pipe:1") -> list[str]:
    return ["ffmpeg", "-i", source, *MP3, *(("-f", "mp3") if out == "pipe:1" else ()), *QUIET, out]


def count_pages(timeout_s: float = 120.0) -> Callable[[dict], int]:
    ask = Command(lambda row: report_arguments(row["pdf_path"]), timeout_s=timeout_s)
    return lambda row: pages_of(ask(row))


def renderer(cfg: Config, timeout_s: float = 120.0) -> Command:
    return Command(lambda row: render_arguments(row["pdf_path"], row["page_no"], cfg.render_dpi()), timeout_s=timeout_s)


def recogniser(cfg: Config, timeout_s: float = 120.0) -> Ocr:
    def recognise(content: bytes, page_mode: int) -> str:
        out = Command(lambda row: recognise_arguments(cfg, page_mode), lambda row: bytes(content), timeout_s)({})
        return out.decode(errors="replace")

    return Ocr(recognise, cfg.tesseract.psm)


def blank_detector(cfg: Config, program: str = "detect-blank", timeout_s: float = 120.0) -> Callable[[dict], int]:
    """The detector's exit code for a row's `content`: 0 blank, 1 not; see names.blank_verdict()."""

    def ask(row: dict) -> int:
        with tempfile.NamedTemporaryFile(suffix=".png") as page:  # read by the program within this call only
            page.write(bytes(row["content"] or b""))
            page.flush()
            return subprocess.run(blank_arguments(program, page.name, cfg), capture_output=True, timeout=timeout_s, check=False).returncode

    return ask


def speaker(cfg: Config, timeout_s: float = 600.0) -> Callable[[dict], bytes]:
    def speak(row: dict) -> bytes:
        with tempfile.TemporaryDirectory() as folder:  # read back within this call
            out = Path(folder, "out.wav")
            Command(lambda r: speech_arguments(cfg.f5_tts_settings.model, r["chunk"], out), timeout_s=timeout_s)(row)
            return out.read_bytes()

    return speak


def encoder(timeout_s: float = 3600.0) -> Command:
    """Takes a row's `wav`, or the file at its `path`."""
    return Command(lambda row: mp3_arguments(row.get("path") or "pipe:0"), lambda row: bytes(row.get("wav") or b""), timeout_s)


def endpoint(model: str, address: str = ENDPOINT) -> str:
    """Where a model is asked; the key is no part of it."""
    return address.format(model=urllib.request.quote(model, safe=""))


def request_body(prompt: str, mime: str, content: bytes) -> bytes:
    """The request of functions.messages.build_request(), for one page."""
    from base64 import b64encode

    parts = [{"text": prompt}, {"inlineData": {"mimeType": mime, "data": b64encode(content).decode()}}]
    settings = {"temperature": messages.TEMPERATURE, "topK": messages.TOP_K, "topP": messages.TOP_P, "maxOutputTokens": messages.MAX_TOKENS}
    return json.dumps({"contents": [{"role": "user", "parts": parts}], "generationConfig": settings}, ensure_ascii=False).encode()


def reply_text(status: int, body: bytes) -> str:
    """What functions.messages.parse_response() gives as text; its errors are raised."""
    try:
        reply = json.loads(body)
    except ValueError:
        reply = None
    told = ((reply.get("error") or {}).get("message") or "") if isinstance(reply, dict) else ""
    if not 200 <= status < 300:
        raise RuntimeError(f"HTTP {status}: {told or body.decode(errors='replace').strip()}")
    if not isinstance(reply, dict):
        raise RuntimeError("undecodable response")
    if told:
        raise RuntimeError(told)
    if not reply.get("candidates"):
        raise RuntimeError(messages.NO_CANDIDATES)
    parts = (reply["candidates"][0].get("content") or {}).get("parts") or []
    return "\n".join(t for p in parts if (t := p.get("text") or "").strip())


@dataclass(frozen=True)
class Model:
    """One request to a model by HTTP; the key is read from the environment where the call is made."""

    key_variable: str
    mime: str = "image/png"
    address: str = ENDPOINT
    timeout_s: float = 120.0

    def __call__(self, model: str, row: dict) -> str:
        headers = {"Content-Type": "application/json", "x-goog-api-key": api_key(self.key_variable)}
        asked = urllib.request.Request(endpoint(model, self.address), request_body(row["prompt"], row.get("mime") or self.mime, bytes(row["content"] or b"")), headers, method="POST")
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout_s) as reply:
                return reply_text(reply.status, reply.read())
        except urllib.error.HTTPError as e:
            return reply_text(e.code, e.read())


def asker(cfg: Config, model: str = "", timeout_s: float = 120.0, address: str = ENDPOINT) -> Retry:
    """The model of a project: `model` alone, or else the default ones in turn."""
    if not cfg.google_api.api_key_variable.strip():
        raise LookupError("google_api.api_key_variable is not set")
    more = {"models": (model,)} if model else {}
    call = Model(cfg.google_api.api_key_variable.strip(), address=address, timeout_s=timeout_s)
    return Retry(call, attempts=cfg.google_api.max_retries, pause_s=cfg.google_api.retry_delay_seconds, **more)


def all_providers(cfg: Config, model: str = "", timeout_s: float = 120.0) -> dict[str, Callable]:
    """Providers of plans.runs.books_to_audio() by the real programs; `ink` is 0 for a blank page and 1
    for others, which any threshold between tells apart."""
    detect = blank_detector(cfg)

    def ink(row: dict) -> float:
        code = detect(row)
        if code not in (0, 1):
            raise Blank(f"blank detector exit code {code}")
        return float(code)

    return {"count": count_pages(), "draw": renderer(cfg), "ink": ink, "ocr": recogniser(cfg), "ask": asker(cfg, model, timeout_s), "speech": speaker(cfg), "encode": encoder()}
