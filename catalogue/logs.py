"""Query-log reports, over logs made of the event and document tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import Query
from plumbline import TableResolver, query_history, query_log_window
from plumbline.functions import first_table_name

QUERIES: dict[str, Query] = {}

AS_OF = datetime(2024, 1, 15)
WINDOW = (
    "start_time >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 1 DAY "
    "AND start_time <= TIMESTAMP '2024-01-15 00:00:00'"
)
EXTRACT = r"nullif(regexp_extract({0}, '(?i)(from|join)\s+([a-zA-Z0-9_\.]+)', 2), '')"


def event_log(tables: TableResolver) -> DataFrame:
    """Events as a query log: clicks and views read tables, the rest names none."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit("SELECT * FROM db.tbl_"), "user_id"))
        .when(kind == "view", F.concat(F.lit("select a join  t"), "user_id", F.lit(" from z")))
        .otherwise("SHOW TABLES")
    )
    return tables("events").select(
        F.col("event_id").cast("string").alias("query_id"),
        F.concat(F.lit("user_"), "user_id").alias("user_name"),
        F.when(kind == "purchase", "SALES").otherwise("WEB").alias("database_name"),
        F.upper(kind).alias("schema_name"),
        F.lit("WH").alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        F.col("value").alias("execution_time"),
        text.alias("query_text"),
    )


EVENT_LOG = (
    "SELECT CAST(event_id AS VARCHAR) AS query_id, 'user_' || user_id AS user_name, "
    "CASE WHEN event_type = 'purchase' THEN 'SALES' ELSE 'WEB' END AS database_name, "
    "upper(event_type) AS schema_name, 'WH' AS warehouse_name, ts AS start_time, "
    "value AS execution_time, "
    "CASE event_type WHEN 'click' THEN 'SELECT * FROM db.tbl_' || user_id "
    "WHEN 'view' THEN 'select a join  t' || user_id || ' from z' "
    "ELSE 'SHOW TABLES' END AS query_text FROM events"
)

QUERIES["query_log_window"] = Query(
    lambda spark, t: query_log_window(event_log(t), AS_OF).agg(F.count("*").alias("n")),
    f"SELECT count(*) AS n FROM ({EVENT_LOG}) AS q WHERE {WINDOW}",
)
QUERIES["query_log_report"] = Query(
    lambda spark, t: query_history(event_log(t), "WEB", AS_OF),
    "SELECT query_id, user_name, database_name, schema_name, warehouse_name, start_time, "
    f"execution_time, {EXTRACT.format('query_text')} AS table_name, query_text "
    f"FROM ({EVENT_LOG}) AS q WHERE {WINDOW} AND database_name = 'WEB' "
    "ORDER BY start_time DESC, query_id",
)


def _tables_used(spark: SparkSession, tables: TableResolver) -> DataFrame:
    used = event_log(tables).select(first_table_name(F.col("query_text")).alias("t"))
    return used.agg(F.count_if(F.col("t").isNull()).alias("no_table"), F.count("t").alias("with_table"))


QUERIES["query_log_tables"] = Query(
    _tables_used,
    f"SELECT count(*) FILTER (WHERE t IS NULL) AS no_table, count(t) AS with_table "
    f"FROM (SELECT {EXTRACT.format('query_text')} AS t FROM ({EVENT_LOG}) AS q) AS u",
)
QUERIES["query_log_prose"] = Query(
    lambda spark, t: t("documents").select(
        "doc_id", first_table_name(F.col("text")).alias("table_name")
    ),
    f"SELECT doc_id, {EXTRACT.format('text')} AS table_name FROM documents",
)
