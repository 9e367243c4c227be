"""Whitespace rules and cleaning of field values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Unicode white space ---------------------------------------------
# `trim` alone knows only the space and `\s` only ASCII, so both would call a no-break
# space text.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as the body of a character class. Written with \s and \p{Z} it matches twice as
# fast as with the ranges spelled out.
WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"


def strip(value: Column) -> Column:
    """Without white space at both ends; looks at the ends only, not at every character."""
    return F.btrim(value, F.lit(WS_CHARS))


def nonblank(value: Column) -> Column:
    """True for text with a visible character; false for null, empty and white space."""
    return F.coalesce(F.rlike(value, F.lit(rf"[^{WS}]")), F.lit(False))


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def clean(value: Column) -> Column:
    """One line, single spaces, without one leading bullet."""
    one_line = F.regexp_replace(strip(or_empty(value.cast("string"))), f"[{WS}]+", " ")
    return F.regexp_replace(one_line, r"\A[-*•][ ]*", "")


def label_of(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
