"""Column functions (F1–F18): every one is a native Spark expression."""

from .money import (  # noqa: F401
    billions_to_amount, cast_measure, cents, millions_to_count,
    nan_to_null, out_of_contract, parse_number, pct, ratio_half_up, strip_money, to_float,
)
from .quarter import (  # noqa: F401
    add_year_quarter, date_quarter_token, find_quarter_column, normalize_quarter,
    quarter_columns, quarter_end, quarter_key, quarter_start,
)
from .text import (  # noqa: F401
    clean_header, first_non_empty, lookup, strip_blanks, text_to_int_truncating, utc_now_iso,
)
