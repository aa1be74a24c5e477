"""Result schemas, and the SQL that grades a count."""

from __future__ import annotations

from pyspark.sql import types as T

# Statuses, audit dimensions, result fields.
PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"
UNIQUENESS = "Uniqueness"
COMPLETENESS = "Completeness"
RECONCILIATION = "Reconciliation"
TIMELINESS = "Timeliness"
EMPTY_TABLE = "division by zero"

RULE_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("dq_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failed", T.LongType()),
        T.StructField("percent", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

# failed_rows is a double: the difference of two sums need not be whole.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_timestamp", T.StringType(), False),
        T.StructField("dq_dimension", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("failed_rows", T.DoubleType(), False),
        T.StructField("edi_business_day", T.StringType(), False),
        T.StructField("dq_comment", T.StringType(), True),
    ]
)


# SQL over the counts of a rule: ``failed``, ``total``, ``zero_when_empty``, ``threshold``.
# The share over no rows is unknown for most checks, zero for some.
PERCENT_SQL = (
    "CASE WHEN total > 0 THEN (CAST(failed AS DOUBLE) / CAST(total AS DOUBLE)) * 100 "
    "WHEN zero_when_empty THEN 0D END"
)
STATUS_SQL = (
    f"CASE WHEN percent IS NULL THEN '{ERROR}' "
    f"WHEN percent <= threshold AND NOT isnan(threshold) THEN '{PASS}' "
    f"ELSE '{FAIL}' END"
)
GRADED_FAILED_SQL = "CASE WHEN percent IS NOT NULL THEN failed END"
GRADED_ERROR_SQL = f"CASE WHEN percent IS NULL THEN '{EMPTY_TABLE}' END"
