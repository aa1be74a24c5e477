"""Values from an allowed list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.rules import RuleContext, dq_check


@dq_check("value_set_check")
def value_set_check(ctx: RuleContext, column: str, allowed_values) -> Column:
    """Known values outside the list fail. A null in the list makes every miss unknown.

    A row rule for any length of list: Spark looks values up in a hash set of the literals.
    """
    allowed = list(allowed_values)
    value = ctx.column(column)
    if None in allowed:
        return F.lit(False) & value.isNull()
    return value.isNotNull() & ~value.isin(allowed)
