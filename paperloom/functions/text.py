"""Row-local text expressions shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size unit: a run of anything but space, tab, newline, return, form feed.
TOKEN_PATTERN = r"[^ \t\n\r\f]+"
# Matching unit: letters and digits of the lowered text.
TERM_PATTERN = r"[\p{L}0-9]+"
# A stretch that ends after its closing marks or at a newline.
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
# What str.strip() removes in Python; SQL trim() alone only removes blanks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), F.lit(0))


def terms(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TERM_PATTERN), F.lit(0))


def strip(text: Column | str) -> Column:
    """Trim every whitespace character on both ends (T5)."""
    return F.trim(_col(text), F.lit(WHITESPACE))


def json_quote(text: Column | str) -> Column:
    """A JSON string literal holding ``text``."""
    boxed = F.to_json(F.struct(_col(text).alias("t")))
    # {"t":"..."} without the braces and the key
    return F.substring(boxed, F.lit(6), F.length(boxed) - 6)


def flatten_json(text: Column | str) -> Column:
    """Newlines to spaces, then JSON-quoted (T4)."""
    return json_quote(F.replace(_col(text), F.lit("\n"), F.lit(" ")))


def sentences(text: Column | str) -> Column:
    """Non-blank stretches ending after ``.``, ``!``, ``?`` or at a newline."""
    found = F.regexp_extract_all(_col(text), F.lit(SENTENCE_PATTERN), F.lit(0))
    return F.filter(F.transform(found, strip), lambda s: s != "")
