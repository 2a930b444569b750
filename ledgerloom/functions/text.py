"""Names, text and record helpers (native column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import parse_number


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c) -> Column:
    """trim leading / trailing white space, that of Unicode included."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def clean_header(name: str) -> str:
    """Header names: strip blanks, then surrounding quotes (driver-side metadata)."""
    return name.strip().strip('"')


def first_non_empty(*cols) -> Column:
    """the first alternative that is neither NULL nor empty (``a or b``)."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])


def lookup(m, key: str) -> Column:
    """map lookup, NULL when the key is absent."""
    return F.try_element_at(_col(m), F.lit(key))


def text_to_int_truncating(c) -> Column:
    """``int(float(text))`` — truncates toward zero, NULL when not a number."""
    return parse_number(c).try_cast("int")


def utc_now_iso() -> Column:
    """generation time as ISO text with a ``Z`` suffix."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
