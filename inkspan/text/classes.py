"""Character classes that mean the same in Java, RE2 and Python, and the column helpers on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters, digits, underscore (Unicode).
W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
#: White space as Python's ``str.isspace`` has it.
WS_IN = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WS = f"[{WS_IN}]"
NOT_WS = f"[^{WS_IN}]"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_of(x) -> Column:
    """The column, with null as the empty text."""
    return F.coalesce(c(x), F.lit(""))


def strip(x) -> Column:
    return F.regexp_replace(c(x), f"^{WS}+|{WS}+\\z", "")


def tokens(x) -> Column:
    """Maximal runs of non-space characters."""
    return F.regexp_extract_all(text_of(x), F.lit(f"{NOT_WS}+"), 0)


def words(x) -> Column:
    """Maximal runs of ASCII letters."""
    return F.regexp_extract_all(text_of(x), F.lit("[A-Za-z]+"), 0)


def rounded(x: Column, digits: int = 4) -> Column:
    """Half-up rounding by one multiplication and one floor, the same in every IEEE engine."""
    m = float(10**digits)
    return F.floor(x * m + 0.5) / F.lit(m)


def ratio(a: Column, b: Column) -> Column:
    """a / b, or 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
