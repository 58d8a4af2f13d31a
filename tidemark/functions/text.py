"""Text helpers shared by the other functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that count as blank at the ends of names, URLs and label lines.
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Text without blanks at both ends."""
    return F.trim(text, F.lit(BLANK_CHARS))


def decode_utf8(content: Column) -> Column:
    """Text of UTF-8 bytes, NULL when they are not valid."""
    return F.try_validate_utf8(content.cast("string"))
