"""What a catalogue entry is, and the SQL shared by the entries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbline import TableResolver, parquet_tables


@dataclass(frozen=True)
class Query:
    """A Spark query over the tables, and the SQL that must give the same rows, if any."""

    run: Callable[[SparkSession, TableResolver], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(spark, parquet_tables(spark, sf_dir))


def counted(base: str, pred: str, scope: str = "TRUE") -> str:
    """SQL for one row: ``n`` rows in scope, ``failed`` of them where ``pred`` is true."""
    return (
        f"SELECT count(*) FILTER (WHERE {scope}) AS n, "
        f"count(*) FILTER (WHERE ({scope}) AND ({pred})) AS failed FROM ({base}) AS base"
    )


def counted_groups(base: str, keys: str) -> str:
    """SQL for one row: ``n`` rows, ``failed`` groups of two or more with equal ``keys``."""
    return (
        "SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) FILTER (WHERE c > 1) AS failed "
        f"FROM (SELECT count(*) AS c FROM ({base}) AS base GROUP BY {keys}) AS grouped"
    )


def graded(dq_type: str, counts: str, threshold: float = 1.0, empty: str = "NULL") -> str:
    """SQL for one graded rule; ``empty`` is the percentage over no rows."""
    return (
        "SELECT dq_type, CASE WHEN percent IS NOT NULL THEN failed END AS failed, percent, "
        f"CASE WHEN percent IS NULL THEN 'ERROR' WHEN percent <= {threshold} THEN 'PASS' "
        "ELSE 'FAIL' END AS status "
        f"FROM (SELECT '{dq_type}' AS dq_type, failed, CASE WHEN n > 0 THEN (failed / n) * 100 "
        f"ELSE CAST({empty} AS DOUBLE) END AS percent FROM ({counts}) AS counts) AS rated"
    )


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder in the one that driver and executors share, ``spark.checkpoint.dir``.

    Without that setting a local master, which has one machine, gets a temporary folder, and any
    other stops: its executors would write to their own disks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="plumbline-")
    return f"{shared.rstrip('/')}/plumbline-{uuid.uuid4().hex}"
