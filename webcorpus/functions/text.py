"""Small Column helpers shared by the parsers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode property White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(col: Column) -> Column:
    """Trim Unicode white space on both sides (``trim`` alone takes blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
