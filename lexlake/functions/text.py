"""String helpers returning Columns.

``trim`` removes blanks only, so stripping uses a Unicode-aware pattern, and dates
are parsed behind a shape check because a plain cast accepts partial dates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
# a midnight time part is tolerated after the date, anything else is not a date
ISO_DATE_OR_MIDNIGHT = r"^\d{4}-\d{2}-\d{2}([Tt ]00:00(:00(\.0{1,6})?)?)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind. Most values have none,
    which a look at the two end characters tells without running a pattern."""
    text = col(c)
    edges = F.left(text, F.lit(1)).isin(*WHITESPACE) | F.right(text, F.lit(1)).isin(*WHITESPACE)
    return F.when(edges, F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).otherwise(text)


def collapse(c: Column | str) -> Column:
    """Strip and turn every inner whitespace run into one blank."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def parse_date(c: Column | str, pattern: str = ISO_DATE) -> Column:
    """ISO date or null; never throws, also in ANSI mode. The shape is checked
    first; what remains for the cast is whether the day exists."""
    text = col(c)
    return F.when(text.rlike(pattern), F.left(text, F.lit(10)).try_cast("date"))


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    return strip(c).try_cast(f"decimal({precision},{scale})")


def header_key(c: Column | str) -> Column:
    """Header spelling used for matching: 'Document ID' and 'document-id' agree."""
    return F.translate(F.lower(strip(c)), " -", "__")


def like_any_case(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; % and _ in the needle are literal."""
    escaped = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return col(c).ilike(f"%{escaped}%")
