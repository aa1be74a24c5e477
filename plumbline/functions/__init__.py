"""Column helpers shared by the checks."""

from plumbline.functions.dates import spark_date_pattern
from plumbline.functions.names import column_named, name_sql, text_literal
from plumbline.functions.patterns import first_table_name, matches_whole
from plumbline.functions.sums import exact_sums

__all__ = [
    "column_named",
    "exact_sums",
    "first_table_name",
    "matches_whole",
    "name_sql",
    "spark_date_pattern",
    "text_literal",
]
