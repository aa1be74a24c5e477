"""Report on a query log kept as a table."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.patterns import first_table_name


def _moment(as_of: datetime | None, data_type: T.DataType) -> Column:
    """``as_of`` as a literal of the log's time type; without a zone it is session time."""
    if as_of is None:
        return F.current_timestamp().cast(data_type)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(UTC)
        if isinstance(data_type, T.TimestampNTZType):
            as_of = as_of.replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast(data_type)


def query_log_window(log: DataFrame, as_of: datetime | None = None, days: int = 1) -> DataFrame:
    """Queries started in the ``days`` up to ``as_of`` (now), both ends included.

    The bounds are literals of the column's own type, so the filter reaches the scan; on a
    log partitioned by day Spark skips the other partitions as far as their statistics tell.
    """
    end = _moment(as_of, log.schema["start_time"].dataType)
    start = end - F.make_interval(days=F.lit(days))
    return log.where(F.col("start_time").between(start, end))


def query_history(
    log: DataFrame, database: str, as_of: datetime | None = None, days: int = 1
) -> DataFrame:
    """The day's queries of one database, latest first, with the first table each one names.

    The query id breaks ties: it also lets the range-partitioned sort split a start time
    shared by many queries over several tasks.
    """
    return (
        query_log_window(log, as_of, days)
        .where(F.col("database_name") == database)
        .select(
            "query_id",
            "user_name",
            "database_name",
            "schema_name",
            "warehouse_name",
            "start_time",
            "execution_time",
            first_table_name(F.col("query_text")).alias("table_name"),
            "query_text",
        )
        .orderBy(F.desc("start_time"), "query_id")
    )
