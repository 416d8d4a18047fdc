"""File names: base names, suffixes, numbers, media types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)\\z", 1)


def base_name(name: Column) -> Column:
    """Without the last extension."""
    return F.regexp_replace(name, "\\.[^.]*\\z", "")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, "(\\.[^./]*)\\z", 1))


def has_suffix(name: Column, suffix: str) -> Column:
    """Case-insensitive."""
    return F.lower(name).endswith(suffix)


def book_name(name: Column, strict_suffix: bool = False) -> Column:
    """A PDF's name without its suffix. strict_suffix strips only the lower-case form."""
    return F.regexp_replace(name, "\\.pdf\\z" if strict_suffix else "\\.(?i:pdf)\\z", "")


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def page_file(n: Column) -> Column:
    return F.format_string("page_%04d.png", n)


def chunk_file(n: Column) -> Column:
    return F.format_string("chunk_%04d.wav", n)


def mime_type(name: Column) -> Column:
    ext = extension(name)
    return F.when(ext.isin(".jpg", ".jpeg"), "image/jpeg").when(ext == ".webp", "image/webp").otherwise("image/png")


def page_number(base: Column) -> Column:
    """The digits after "page"; 0 where they are no 64-bit number, null where there are none."""
    digits = F.regexp_extract(base, "(?i)page[_\\-\\t\\n\\f\\r ]*([0-9]+)", 1)
    return F.when(digits != "", F.coalesce(digits.try_cast("bigint"), F.lit(0)))


def document_order(base: Column) -> list[Column]:
    """Sort keys: numbered names by number, then the others, each by lower-cased name; the name itself
    settles what is left."""
    n = page_number(base)
    return [n.isNull(), n, F.lower(base), base]


def page_count(report: Column) -> Column:
    """Pages told by a document report's line; null unless it is a number above zero."""
    n = F.regexp_extract(report, "(?m)^Pages:[\\t ]+(\\S+)", 1).try_cast("int")
    return F.when(n > 0, n)


def blank_verdict(exit_code: Column) -> Column:
    """(blank, error) of the blank detector's exit code."""
    bad = ~exit_code.isin(0, 1)
    return F.struct(F.when(~bad, exit_code == 0).alias("blank"), F.when(bad, F.concat(F.lit("blank detector exit code "), exit_code.cast("string"))).alias("error"))
