"""Text helpers shared by the parsers and the lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a lookup key.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The words that mean yes.
YES = ("true", "1", "t", "yes", "y")


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (`trim` alone only drops spaces)."""
    return F.btrim(text, F.lit(WHITESPACE))


def lookup_key(url: Column) -> Column:
    """Lower case and stripped; no scheme, path or ``www.`` handling."""
    return strip(F.lower(url))


def non_empty(text: Column) -> Column:
    """NULL for the empty string, so that `coalesce` takes the next candidate."""
    return F.nullif(text, F.lit(""))


def first_non_empty(*candidates: Column) -> Column:
    return F.coalesce(*[non_empty(c) for c in candidates], F.lit(""))


def normalize_header(header: Column) -> Column:
    """Lower-case letters and digits of a header, nothing else. For reports only:
    records keep their headers as they are."""
    return F.regexp_replace(F.lower(header), "[^a-z0-9]", "")


def is_true(flag: Column, dtype: str = "string") -> Column:
    """Whether a flag marks an AI tool. Text must spell one of five words; a number
    must not be zero; NULL is false."""
    if dtype == "string":
        truth = lookup_key(flag).isin(*YES)
    elif dtype == "boolean":
        truth = flag
    else:
        truth = flag != F.lit(0)
    return F.coalesce(truth, F.lit(False))
