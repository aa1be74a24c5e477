"""The Parquet audit log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from plumbline.results import AUDIT_SCHEMA


def append_audit(records: DataFrame, path: str) -> DataFrame:
    """Append audit records to the Parquet folder ``path`` and return them.

    The records are few (a handful per audited column). They are computed once and come back
    as literal rows, so that neither the write nor the caller scans the audited tables again,
    and a run adds one file.
    """
    rows = records.select(*AUDIT_SCHEMA.names).collect()
    frame = records.sparkSession.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1)
    frame.write.mode("append").parquet(path)
    return frame


def write_dq_results(
    spark: SparkSession, dq_results: DataFrame | Sequence[Mapping[str, Any] | Row], path: str
) -> DataFrame:
    """The same for records given as a frame, as rows or as mappings."""
    if not isinstance(dq_results, DataFrame):
        names = AUDIT_SCHEMA.names
        as_given = {n: float if n == "failed_rows" else (lambda x: x) for n in names}
        rows = [tuple(as_given[n](r[n]) for n in names) for r in dq_results]
        dq_results = spark.createDataFrame(rows, AUDIT_SCHEMA)
    return append_audit(dq_results, path)
