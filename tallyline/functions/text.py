"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(column: Column) -> Column:
    """Without leading and trailing white space.

    ``trim`` removes only blanks but is fast, and nearly always enough: the general form
    runs only where the trimmed text still starts or ends with something other than a
    printable ASCII character.
    """
    text = F.trim(column)
    first, last = F.ascii(text), F.ascii(F.substring(text, -1, 1))
    plain = first.between(33, 126) & last.between(33, 126)
    return F.when(plain, text).otherwise(F.btrim(column, F.lit(WHITESPACE)))


def stripped_or_null(column: Column) -> Column:
    return F.nullif(stripped(column), F.lit(""))


def contains_pattern(pattern: str, *columns: str) -> Column:
    """Case-insensitive match in any of the columns; a null column never matches."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).rlike(f"(?i){pattern}"), F.lit(False))
    return hit
