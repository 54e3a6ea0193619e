"""starforge: a star-schema warehouse library on Spark DataFrames.

Staging loads, data-quality checks, slowly changing dimensions, fact builds
with surrogate lookups, incremental splits with fact history, archive, and
report measures — all as lazy DataFrame transformations.
"""

__version__ = "0.1.0"
