"""Checks that look at one row at a time.

Each builder returns the predicate that marks a failing row. A null input makes most of
them unknown and so passes; ``null_check`` and ``date_validity_check`` fail it on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.dates import spark_date_pattern
from plumbline.functions.patterns import DIGITS_TEXT, NUMBER_TEXT, matches_part, matches_whole
from plumbline.rules import RowRule, RuleContext, dq_check

# Type names the type rule accepts.
NUMBER_TYPES = {"NUMBER", "INT", "INTEGER", "FLOAT", "DECIMAL"}
DATE_TYPES = {"DATE", "TIMESTAMP"}
TEXT_TYPES = {"STRING", "VARCHAR", "TEXT"}
DATED_TEXT = r"\A\d{4}-\d{1,2}-\d{1,2}([ T].+)?\z"
DEFAULT_DATE_FORMAT = "YYYY-MM-DD"


def _never() -> Column:
    return F.lit(False)


@dq_check("null_check")
def null_check(ctx: RuleContext, column: str) -> Column:
    return ctx.column(column).isNull()


@dq_check("blank_check")
def blank_check(ctx: RuleContext, column: str) -> Column:
    return F.trim(ctx.column(column)) == ""


@dq_check("regex_check")
def regex_check(
    ctx: RuleContext, column: str, pattern: str, full_match: bool = True
) -> Column:
    """The whole text must match; with ``full_match=False`` any part of it may."""
    text = ctx.column(column)
    return ~(matches_whole(text, pattern) if full_match else matches_part(text, pattern))


def _outside(value: Column, low, high) -> Column:
    """Below ``low`` or above ``high``; a missing bound does not bind."""
    sides = []
    if low is not None:
        sides.append(value < low)
    if high is not None:
        sides.append(value > high)
    if not sides:
        return _never()
    return sides[0] if len(sides) == 1 else sides[0] | sides[1]


@dq_check("range_check")
def range_check(ctx: RuleContext, column: str, min_val=None, max_val=None) -> Column:
    return _outside(ctx.column(column), min_val, max_val)


@dq_check("length_check")
def length_check(ctx: RuleContext, column: str, min_len=None, max_len=None) -> Column:
    return _outside(F.length(ctx.column(column)), min_len, max_len)


@dq_check("cross_field_check")
def cross_field_check(ctx: RuleContext, column: str, operator: str, col2: str) -> Column:
    """``column <operator> col2`` must hold where both are known."""
    left, right = ctx.column(column), ctx.column(col2)
    violated = {
        ">": left <= right,
        "<": left >= right,
        ">=": left < right,
        "<=": left > right,
        "=": left != right,
        "==": left != right,
        "!=": left == right,
        "<>": left == right,
    }
    if operator not in violated:
        raise ValueError(f"Unsupported operator: {operator}")
    return violated[operator]


@dq_check("data_type_check")
def data_type_check(ctx: RuleContext, column: str, expected_type: str) -> Column:
    """Text must read as the expected type; a column that already has the type passes."""
    expected = expected_type.upper()
    have = ctx.data_type(column)
    text = ctx.column(column).cast("string")
    if expected in NUMBER_TYPES:
        return _never() if isinstance(have, T.NumericType) else ~matches_whole(text, NUMBER_TEXT)
    if expected in DATE_TYPES:
        if isinstance(have, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return _never()
        # A date or timestamp is text with a full date, and a time if any, that exists.
        return ~text.rlike(DATED_TEXT) | (F.try_to_timestamp(text).isNull() & text.isNotNull())
    if expected in TEXT_TYPES:
        return matches_whole(text, DIGITS_TEXT)
    raise ValueError(f"Unsupported expected_type: {expected}")


@dq_check("date_validity_check")
def date_validity_check(
    ctx: RuleContext, column: str, date_format: str = DEFAULT_DATE_FORMAT
) -> Column:
    """Null and unreadable dates fail."""
    return F.try_to_date(ctx.column(column), spark_date_pattern(date_format)).isNull()


@dq_check("custom_expression_check")
def custom_expression_check(ctx: RuleContext, column: str | None, expression: str) -> Column:
    """``expression`` must hold; the configured column is only a label."""
    return ~F.expr(expression)


@dq_check("conditional_check")
def conditional_check(
    ctx: RuleContext, column: str | None, condition: str, col: str, expected_value
) -> RowRule:
    """Where ``condition`` is true, ``col`` must equal the value; other rows do not count."""
    holds = F.expr(condition)
    wrong = ctx.column(col) != F.lit(expected_value)
    return RowRule(holds & wrong, scope=holds, zero_when_empty=True)
