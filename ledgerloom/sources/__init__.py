"""Sources: quarterly CSVs, observation series, key/value records."""

from .csv_files import (  # noqa: F401
    contract_projection, empty_frame, extract_balances, extract_origination, read_csv_map, read_fed_csv,
)
from .records import lending_yearly, read_xml_records  # noqa: F401
from .series import parse_date, read_series, series_from_frame  # noqa: F401
