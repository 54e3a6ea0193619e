"""Column-level functions (return ``Column``); all built-in, codegen friendly."""

from .dates import (completed_years, date_key, day_name, day_of_week0, fiscal_quarter,
                    fiscal_year, is_weekend, month_name, month_start)
from .hashing import change_hash
from .predicates import (divide, hash_differs, is_missing, members, out_of_range, since)

__all__ = [
    "change_hash", "completed_years", "date_key", "day_name", "day_of_week0", "divide",
    "fiscal_quarter", "fiscal_year", "hash_differs", "is_missing", "is_weekend", "members",
    "month_name", "month_start", "out_of_range", "since",
]
