"""Sources: raw files, CSV, warehouse tables, seeds, calendar, archive."""

from .calendar import build_d_date, date_series, month_spine
from .files import (csv_to_parquet, file_information, high_water_mark, incremental_extract, read_archive,
                    read_raw, read_table, seed_rows)

__all__ = [
    "build_d_date", "csv_to_parquet", "date_series", "file_information", "high_water_mark", "incremental_extract",
    "month_spine", "read_archive", "read_raw", "read_table", "seed_rows",
]
