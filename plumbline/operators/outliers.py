"""Outliers by z-score."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.rules import RowRule, RuleContext, dq_check


@dq_check("outlier_check")
def outlier_check(ctx: RuleContext, column: str, z_threshold: float = 3) -> RowRule:
    """Further than ``z_threshold`` sample standard deviations from the mean.

    Mean and deviation come as a one-row scalar subquery, so the rule stays a row rule:
    one scan for the statistics of all outlier rules of a table (Catalyst merges the
    subqueries) and the shared scan that counts. With no spread (one row, constant column)
    or an undefined one (NaN in the data) nothing fails.
    """
    value = ctx.column(column).cast("double")
    spread = ctx.df.agg(
        F.struct(F.mean(value).alias("mean"), F.stddev(value).alias("deviation"))
    ).scalar()
    mean, deviation = spread["mean"], spread["deviation"]
    usable = (deviation > 0) & ~F.isnan(deviation)
    far = F.abs((value - mean) / deviation) > z_threshold
    return RowRule(F.when(usable, far).otherwise(False), zero_when_empty=True)
