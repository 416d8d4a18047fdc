"""Project configuration: a TOML file found by walking up from a folder."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path

FILE = "project.toml"


@dataclass(frozen=True)
class Project:
    name: str = ""
    version: str = ""


@dataclass(frozen=True)
class Paths:
    input_dir: str = ""
    output_dir: str = ""


@dataclass(frozen=True)
class Settings:
    dpi: int = 0
    workers: int = 0
    skip_blank_pages: bool = False


@dataclass(frozen=True)
class Tesseract:
    language: str = "eng+equ"
    oem: int = 3
    psm: int = 3


@dataclass(frozen=True)
class GoogleApi:
    api_key_variable: str = ""
    max_retries: int = 3
    retry_delay_seconds: int = 30


@dataclass(frozen=True)
class Tts:
    model: str = "E2TTS_Base"


@dataclass(frozen=True)
class Concatenation:
    text_type: str = "final_text"


@dataclass(frozen=True)
class BlankDetection:
    fast_fuzz_percent: int = 5
    fast_non_white_threshold: float = 0.005


@dataclass(frozen=True)
class Prompt:
    prompt: str = ""


@dataclass(frozen=True)
class Prompts:
    extract_text: Prompt = field(default_factory=Prompt)


@dataclass(frozen=True)
class Config:
    """The keys that a stage reads; others in the file are ignored."""

    project: Project = field(default_factory=Project)
    paths: Paths = field(default_factory=Paths)
    settings: Settings = field(default_factory=Settings)
    tesseract: Tesseract = field(default_factory=Tesseract)
    google_api: GoogleApi = field(default_factory=GoogleApi)
    f5_tts_settings: Tts = field(default_factory=Tts)
    text_concatenation: Concatenation = field(default_factory=Concatenation)
    blank_detection: BlankDetection = field(default_factory=BlankDetection)
    prompts: Prompts = field(default_factory=Prompts)

    def require_dirs(self) -> None:
        if not self.paths.input_dir or not self.paths.output_dir:
            raise ValueError("paths.input_dir and paths.output_dir must be set")

    def render_dpi(self) -> int:
        return self.settings.dpi if self.settings.dpi > 0 else 200

    def ocr_dpi(self) -> int:
        return self.settings.dpi if self.settings.dpi > 0 else 300

    def ocr_workers(self, cores: int) -> int:
        return min(64, self.settings.workers if self.settings.workers > 0 else cores)


def _fill(kind: type, values: dict):
    found = {}
    for f in fields(kind):
        if f.name not in values:
            continue
        default = f.default_factory() if callable(f.default_factory) else f.default
        value = values[f.name]
        # Zero and empty values mean that the default holds.
        found[f.name] = _fill(type(default), value) if is_dataclass(default) else value if value or isinstance(value, bool) else default
    return kind(**found)


def load(path: str | Path) -> Config:
    with open(path, "rb") as f:
        return _fill(Config, tomllib.load(f))


def find_project_root(start: str | Path) -> tuple[Path, Path]:
    """(folder, file) of the nearest project file at or above start; FileNotFoundError if there is none."""
    at = Path(start).resolve()
    for folder in (at, *at.parents):
        if (folder / FILE).is_file():
            return folder, folder / FILE
    raise FileNotFoundError(f"no {FILE} at or above {at}")
