"""Cleaning of recognised text, as Column expressions.

Patterns follow RE2: `\\b` is ASCII, `\\s` is tab, newline, form feed, carriage return and space, and
case folding is Unicode's. Java differs in each, so that all three are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = "[\\t\\n\\f\\r ]"
_WORD = "[0-9A-Za-z_]"
# Patterns begin with plain letters, and look around only where these are found.
BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
#: Unicode White_Space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# What characters are replaced by.
REPLACED = (
    ("ﬁ", "fi"),
    ("ﬂ", "fl"),
    ("ﬀ", "ff"),
    ("ﬃ", "ffi"),
    ("ﬄ", "ffl"),
    ("—", "--"),
    ("–", "--"),
    ("…", "..."),
    ("\r", ""),
)


def normalize_chars(c: Column) -> Column:
    """Ligatures, dashes and ellipses as ASCII; carriage returns go."""
    for old, new in REPLACED:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_preprint(c: Column) -> Column:
    return F.regexp_replace(c, f"[pP](?<!{_WORD}[pP])(?iu:reprints?){BOUNDARY}['’]*", "")


def strip_diacritics_notice(c: Column) -> Column:
    return F.regexp_replace(c, f"[dD](?<!{_WORD}[dD])(?iu:etected){SPACES}+[0-9]+{SPACES}+(?iu:diacritics){BOUNDARY}", "")


def strip_no_best_words(c: Column) -> Column:
    return F.regexp_replace(c, f"[nN](?iu:o){SPACES}+(?iu:best){SPACES}+(?iu:words)!+", "")


def strip_artifacts(c: Column) -> Column:
    return strip_no_best_words(strip_diacritics_notice(strip_preprint(c)))


def join_hyphens(c: Column) -> Column:
    """Words parted by a hyphen and a line break are joined; matches do not overlap."""
    return F.regexp_replace(c, f"([a-z])-{SPACES}*\\n{SPACES}*([a-z])", "$1$2")


def trim_space(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_punctuation_only(line: Column) -> Column:
    return line.rlike("\\A[\\p{P}\\t\\n\\f\\r ]+\\z")


def collapse_spaces(line: Column) -> Column:
    return F.regexp_replace(line, "[ \\t]{2,}", " ")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def normalize_lines(c: Column) -> Column:
    """Lines trimmed, empty and punctuation-only ones dropped, runs of blanks made one."""
    kept = F.filter(F.transform(lines(c), trim_space), lambda line: (line != "") & ~is_punctuation_only(line))
    return F.array_join(F.transform(kept, collapse_spaces), "\n")


def clean_text(c: Column) -> Column:
    """All steps in order; an empty text stays empty, null stays null."""
    return trim_space(normalize_lines(join_hyphens(strip_artifacts(normalize_chars(c)))))


def clean_or_raw(c: Column) -> Column:
    """The cleaned text, or the raw one where cleaning leaves nothing."""
    return F.coalesce(F.nullif(clean_text(c), F.lit("")), c)
