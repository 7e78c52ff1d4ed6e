"""Text normalisation that stays inside Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(c))


def blank_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


def title_case(c: str | Column) -> Column:
    """Capital after every non-letter (``initcap`` only looks at white space)."""
    lowered = F.lower(c)
    runs = F.regexp_extract_all(lowered, F.lit(r"(\p{Ll}+|\P{Ll}+)"), F.lit(1))
    capital = F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x))))
    return F.array_join(capital, "")


def capture(c: str | Column, pattern: str) -> Column:
    """First capture group, stripped; NULL when the pattern is absent or the capture blank."""
    return F.nullif(strip(F.regexp_extract(c, pattern, 1)), F.lit(""))


def strip(c: str | Column) -> Column:
    """Trim every kind of white space, not only blanks (a scan from both ends, no regex)."""
    return F.btrim(c, F.lit(WHITE_SPACE))
