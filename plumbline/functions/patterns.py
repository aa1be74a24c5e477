"""Regular expressions used by the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms the type rule accepts, and the table-name search of the
# query-log report.
NUMBER_TEXT = r"-?\d+(\.\d+)?"
DIGITS_TEXT = r"\d+"
TABLE_AFTER_KEYWORD = r"(?i)(from|join)\s+([a-zA-Z0-9_\.]+)"


def _checked(pattern: str) -> str:
    if not isinstance(pattern, str):
        raise TypeError(f"a pattern must be text, got {type(pattern).__name__}")
    return pattern


def matches_part(text: Column, pattern: str) -> Column:
    """True when ``pattern`` occurs in ``text``."""
    return text.rlike(_checked(pattern))


def matches_whole(text: Column, pattern: str) -> Column:
    r"""True when ``pattern`` covers all of ``text``.

    ``rlike`` searches, and ``$`` also matches before a final newline, so the pattern is
    anchored with ``\A`` and ``\z``.
    """
    return text.rlike(rf"\A(?:{_checked(pattern)})\z")


def first_table_name(query_text: Column) -> Column:
    """First name after FROM or JOIN, NULL when there is none."""
    return F.nullif(F.regexp_extract(query_text, TABLE_AFTER_KEYWORD, 2), F.lit(""))
