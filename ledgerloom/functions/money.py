"""Money, count and percent text → numbers (native column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import MEASURE_TYPES

# Tokens that mean "no value" after stripping.
NULL_TOKENS = ["null", "None", "", "."]

# A plain decimal / scientific number, optional sign, surrounding blanks.
# Spark's own string→double cast also accepts "1d", "1f", "NaN" and
# "Infinity"; none of those is a number in the source files.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_money(c) -> Column:
    """drop ``$``, ``,`` and ``%``; the null tokens become NULL."""
    s = F.translate(_col(c).cast("string"), "$,%", "")
    return F.when(~s.isin(NULL_TOKENS), s)


def nan_to_null(c) -> Column:
    """NaN and ±inf are not values: map them to NULL (never past a cleaner)."""
    x = _col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def parse_number(c) -> Column:
    """Text → double, anything unparsable → NULL (the cast drops
    the blanks around the number itself)."""
    s = _col(c).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), nan_to_null(s.try_cast("double")))


def to_float(c) -> Column:
    """F1 + F2: money / percent text → double."""
    return parse_number(strip_money(c))


def billions_to_amount(c) -> Column:
    """$ billions text → dollars."""
    return to_float(c) * F.lit(1_000_000_000.0)


def millions_to_count(c) -> Column:
    """millions text → count, rounded before the integer cast."""
    return F.round(to_float(c) * F.lit(1_000_000.0)).try_cast("bigint")


def round_half_up(c) -> Column:
    """Double → nearest integer (bigint), halves away from zero.

    ``floor(|x| + 0.5)`` with the sign restored: the same IEEE operations in
    every engine, and much cheaper than a decimal round per row.
    """
    x = _col(c)
    return F.when(x >= 0, F.floor(x + F.lit(0.5))).otherwise(-F.floor(-x + F.lit(0.5))).cast("bigint")


def cents(c) -> Column:
    """Dollars (double) → integer cents; sums of cents are exact in any order."""
    return round_half_up(_col(c) * F.lit(100.0))


def ratio_half_up(n, d, places: int) -> Column:
    """n / d rounded half-up to ``places`` decimals in integer arithmetic.

    Used for report percentages so every engine gets the same digits.
    """
    scale = 10 ** places
    n, d = _col(n).cast("bigint"), _col(d).cast("bigint")
    return F.floor((n * F.lit(2 * scale) + d) / (d * F.lit(2))) / F.lit(float(scale))


def pct(n, d) -> Column:
    """F16: percent of total, 0.0 when the total is 0, rounded to 2 decimals
    with exact halves going to the even digit (1 of 800 is 0.12)."""
    n, d = _col(n).cast("bigint"), _col(d).cast("bigint")
    whole = F.floor(n * F.lit(10_000) / d)
    left = (n * F.lit(10_000) - whole * d) * F.lit(2)
    up = (left > d) | ((left == d) & (whole % 2 == 1))
    return F.when(d == 0, F.lit(0.0)).otherwise((whole + up.cast("bigint")) / F.lit(100.0)).cast("double")


def cast_measure(c, name: str) -> Column:
    """typed nullable cast of one measure to its load contract.

    A value that does not fit the contract becomes NULL here; the load
    rejects such values first (see ``quality.precision_gate``).
    """
    return _col(c).try_cast(MEASURE_TYPES[name]).alias(name)


def out_of_contract(c, name: str) -> Column:
    """True where a value is present but does not fit its load type."""
    return _col(c).isNotNull() & _col(c).try_cast(MEASURE_TYPES[name]).isNull()
