"""Membership of a column's values in another set of keys.

Values and keys are stacked and grouped by value, and each group tells its rows from its keys.
The grouping combines on the map side: a value held by a third of all rows leaves every task as
one record, and a small key domain shuffles next to nothing. There is no join, so there is
neither a skewed join partition nor a side to broadcast. All references of a table are stacked
together, so that the table is read once for all of them.

Texts of more than 32 bytes travel as their SHA-256 digest of 32 bytes: equal texts have equal
digests, and no two unlike ones are known that have. Shorter texts travel as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.names import column_named
from plumbline.rules import ReferenceRule, RuleContext, dq_check

DIGEST_BYTES = 32


def _common_type(df: DataFrame, rule: ReferenceRule) -> T.DataType:
    """The type in which a value and a key of unlike types are compared."""
    return df.select(rule.value).union(rule.keys.select(rule.key)).schema[0].dataType


def _compact(value: Column, data_type: T.DataType) -> Column:
    """What stands for a value: long texts by their digest, marked by a first byte."""
    typed = value.cast(data_type)
    if data_type != T.StringType():
        return typed
    raw = typed.cast("binary")
    long = F.concat(F.unhex(F.lit("01")), F.unhex(F.sha2(raw, 256)))
    return F.when(F.octet_length(typed) > DIGEST_BYTES, long).otherwise(
        F.concat(F.unhex(F.lit("00")), raw)
    )


def count_missing(df: DataFrame, rules: Sequence[ReferenceRule]) -> DataFrame:
    """A row for each rule: ``rule``, its index, ``failed``, the rows of ``df`` whose value is no
    key, and ``total``. A null value has no key, not even a null one, and counts as failed.
    """
    types = [_common_type(df, r) for r in rules]
    # One column for each type that occurs; a rule fills its own.
    kinds = {t.simpleString(): f"value_{i}" for i, t in enumerate(dict.fromkeys(types))}
    shapes = {kinds[t.simpleString()]: "binary" if t == T.StringType() else t for t in types}

    def row(i: int, value: Column, is_row: bool) -> Column:
        own = kinds[types[i].simpleString()]
        fields = [F.lit(i).alias("rule"), F.lit(is_row).alias("is_row")]
        for name, shape in shapes.items():
            filled = _compact(value, types[i]) if name == own else F.lit(None)
            fields.append(filled.cast(shape).alias(name))
        return F.struct(*fields)

    values = F.array(*[row(i, r.value, True) for i, r in enumerate(rules)])
    stacked = df.select(F.explode(values).alias("r"))
    for i, r in enumerate(rules):
        stacked = stacked.union(r.keys.select(row(i, r.key, False)))
    columns = list(shapes)
    per_value = (
        stacked.select("r.*")
        .groupBy("rule", *columns)
        .agg(F.expr("count_if(is_row) AS rows"), F.expr("count_if(NOT is_row) AS keys"))
    )
    known = " OR ".join(f"{c} IS NOT NULL" for c in columns)
    missing = f"keys = 0 OR NOT ({known})"
    counted = per_value.groupBy("rule").agg(
        F.expr(f"coalesce(sum(CASE WHEN {missing} THEN rows END), 0) AS failed"),
        F.expr("coalesce(sum(rows), 0) AS total"),
    )
    every = df.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("rule"))
    none = every.selectExpr("rule", "0L AS failed", "0L AS total")
    return counted.union(none).groupBy("rule").agg(
        F.sum("failed").alias("failed"), F.sum("total").alias("total")
    )


@dq_check("referential_check")
def referential_check(
    ctx: RuleContext, column: str, ref_table: str, ref_col: str
) -> ReferenceRule:
    """Rows whose value is not in ``ref_table.ref_col``; a null value fails."""
    ref = ctx.tables(ref_table)
    return ReferenceRule(ctx.column(column), ref, column_named(ref, ref_col))
