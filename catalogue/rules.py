"""One rule per query: ``dq_type, failed, percent, status``.

The test tables hold no nulls and few defects, so some queries derive them: a value of some
rows is replaced, depending on another column. Every query reads all rows of its tables.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import Query, counted, counted_groups, graded
from plumbline import TableResolver, dq_check, frames, plan_dq_from_config
from plumbline.rules import RuleContext

QUERIES: dict[str, Query] = {}


@dq_check("upper_case_check")
def upper_case_check(ctx: RuleContext, column: str):
    """A check registered by a user: text must not change when upper-cased."""
    return F.upper(ctx.column(column)) != ctx.column(column)


@dq_check("group_total_check")
def group_total_check(ctx: RuleContext, column: str, by: str, most: float) -> DataFrame:
    """A registered check with its own grouping: groups whose column sum exceeds ``most``."""
    totals = ctx.df.groupBy(ctx.column(by)).agg(F.sum(ctx.column(column)).alias("sum_of_group"))
    return totals.agg(
        F.count_if(F.col("sum_of_group") > most).alias("failed"), F.count("*").alias("total")
    )


def add(
    name: str,
    frame: Callable[[TableResolver], DataFrame],
    rule: tuple[str, str, dict[str, Any]],
    counts: str,
    threshold: float = 1.0,
    empty: str = "NULL",
) -> None:
    """Register a query for one rule ``(dq_type, column, params)`` on ``frame``."""
    dq_type, column, params = rule
    config_rule = {"dq_type": dq_type, "params": params, "threshold": threshold}
    config = {
        "tables": [{"name": "base", "columns": [{"name": column, "dq_rules": [config_rule]}]}]
    }

    def run(spark: SparkSession, tables: TableResolver) -> DataFrame:
        resolver = frames({"base": frame(tables)}, otherwise=tables)
        return plan_dq_from_config(spark, config, resolver).select(
            "dq_type", "failed", "percent", "status"
        )

    QUERIES[name] = Query(run, graded(dq_type, counts, threshold, empty))


def table(name: str) -> Callable[[TableResolver], DataFrame]:
    return lambda tables: tables(name)


def documents_with_labels(tables: TableResolver) -> DataFrame:
    return tables("documents").select("doc_id").join(tables("labels"), "doc_id", "left")


def lines_with_orders(tables: TableResolver) -> DataFrame:
    lines, orders = tables("lineitem"), tables("orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_shipdate", "o_orderdate"
    )


DOCUMENTS_WITH_LABELS = (
    "SELECT l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
LINES_WITH_ORDERS = (
    "SELECT l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)

# Nulls and blanks

add(
    "null_check",
    documents_with_labels,
    ("null_check", "quality", {}),
    counted(DOCUMENTS_WITH_LABELS, "quality IS NULL"),
)
add(
    "blank_check",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", "   ").otherwise(F.col("event_type")).alias("x")
    ),
    ("blank_check", "x", {}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN '   ' ELSE event_type END AS x FROM events",
        "trim(x) = ''",
    ),
)
add(
    "blank_check_null_text",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", " ")
        .when(F.col("event_type") != "view", F.col("event_type"))
        .alias("x")
    ),
    ("blank_check", "x", {}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN ' ' WHEN event_type <> 'view' "
        "THEN event_type END AS x FROM events",
        "trim(x) = ''",
    ),
)

# Patterns

add(
    "regex_check",
    table("part"),
    ("regex_check", "p_brand", {"pattern": "Brand#[0-9]"}),
    counted("SELECT p_brand FROM part", "NOT regexp_full_match(p_brand, 'Brand#[0-9]')"),
)
add(
    "regex_search",
    table("part"),
    ("regex_check", "p_brand", {"pattern": "Brand#[0-9]", "full_match": False}),
    counted("SELECT p_brand FROM part", "NOT regexp_matches(p_brand, 'Brand#[0-9]')"),
)
add(
    "regex_check_url",
    table("pages"),
    ("regex_check", "url", {"pattern": r"https?://[a-z0-9.\-]+(/.*)?"}),
    counted("SELECT url FROM pages", r"NOT regexp_full_match(url, 'https?://[a-z0-9.\-]+(/.*)?')"),
)

# Ranges

add(
    "range_check",
    table("orders"),
    ("range_check", "o_totalprice", {"min_val": 10000, "max_val": 450000}),
    counted("SELECT o_totalprice FROM orders", "o_totalprice < 10000 OR o_totalprice > 450000"),
)
add(
    "range_check_threshold",
    table("orders"),
    ("range_check", "o_totalprice", {"min_val": 10000, "max_val": 450000}),
    counted("SELECT o_totalprice FROM orders", "o_totalprice < 10000 OR o_totalprice > 450000"),
    threshold=15.0,
)
add(
    "range_check_min",
    table("lineitem"),
    ("range_check", "l_quantity", {"min_val": 3}),
    counted("SELECT l_quantity FROM lineitem", "l_quantity < 3"),
)
add(
    "range_check_max",
    table("lineitem"),
    ("range_check", "l_discount", {"max_val": 0.08}),
    counted("SELECT l_discount FROM lineitem", "l_discount > 0.08"),
)
add(
    "range_check_unbounded",
    table("lineitem"),
    ("range_check", "l_discount", {}),
    counted("SELECT l_discount FROM lineitem", "FALSE"),
)
add(
    "range_check_null_value",
    documents_with_labels,
    ("range_check", "quality", {"min_val": 1}),
    counted(DOCUMENTS_WITH_LABELS, "quality < 1"),
)

# Outliers

add(
    "outlier_check",
    table("events"),
    ("outlier_check", "value", {}),
    counted(
        "SELECT value, (SELECT avg(value) FROM events) AS m, "
        "(SELECT stddev_samp(value) FROM events) AS s FROM events",
        "abs((value - m) / s) > 3",
    ),
)
add(
    "outlier_long_text",
    table("documents"),
    ("outlier_check", "n_chars", {}),
    counted(
        "SELECT n_chars, (SELECT avg(n_chars) FROM documents) AS m, "
        "(SELECT stddev_samp(n_chars) FROM documents) AS s FROM documents",
        "abs((n_chars - m) / s) > 3",
    ),
)
add(
    "outlier_z_threshold",
    table("lineitem"),
    ("outlier_check", "l_extendedprice", {"z_threshold": 2}),
    counted(
        "SELECT l_extendedprice AS x, (SELECT avg(l_extendedprice) FROM lineitem) AS m, "
        "(SELECT stddev_samp(l_extendedprice) FROM lineitem) AS s FROM lineitem",
        "abs((x - m) / s) > 2",
    ),
)
add(
    "outlier_constant",
    lambda t: t("events").select(F.length(F.rpad("event_type", 7, ".")).alias("x")),
    ("outlier_check", "x", {}),
    counted("SELECT length(rpad(event_type, 7, '.')) AS x FROM events", "x <> 7"),
)

# Two columns

for _name, _operator, _violated in [
    ("cross_field_check", ">", "<="),
    ("cross_field_less", "<", ">="),
    ("cross_field_at_least", ">=", "<"),
    ("cross_field_at_most", "<=", ">"),
    ("cross_field_equal", "=", "<>"),
    ("cross_field_unequal", "!=", "="),
]:
    add(
        _name,
        lines_with_orders,
        ("cross_field_check", "l_shipdate", {"operator": _operator, "col2": "o_orderdate"}),
        counted(LINES_WITH_ORDERS, f"l_shipdate {_violated} o_orderdate"),
    )

# References

add(
    "referential_check",
    table("orders"),
    ("referential_check", "o_orderkey", {"ref_table": "lineitem", "ref_col": "l_orderkey"}),
    counted(
        "SELECT NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS bad "
        "FROM orders",
        "bad",
    ),
)
add(
    "referential_null_key",
    lambda t: t("events").select(F.when(F.col("event_type") != "view", F.col("user_id")).alias("u")),
    ("referential_check", "u", {"ref_table": "customer", "ref_col": "c_custkey"}),
    counted(
        "SELECT NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = u) AS bad "
        "FROM (SELECT CASE WHEN event_type <> 'view' THEN user_id END AS u FROM events)",
        "bad",
    ),
)
add(
    "referential_hot_key",
    lambda t: t("lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_partkey")).alias("k")
    ),
    ("referential_check", "k", {"ref_table": "part", "ref_col": "p_partkey"}),
    counted(
        "SELECT NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = k) AS bad FROM "
        "(SELECT CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_partkey END AS k FROM lineitem)",
        "bad",
    ),
)
add(
    "referential_small_table",
    table("customer"),
    ("referential_check", "c_nationkey", {"ref_table": "nation", "ref_col": "n_regionkey"}),
    counted(
        "SELECT NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey = c_nationkey) AS bad "
        "FROM customer",
        "bad",
    ),
)
add(
    "referential_text_key",
    table("documents"),
    ("referential_check", "text", {"ref_table": "benchmark", "ref_col": "text"}),
    counted(
        "SELECT NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text) AS bad "
        "FROM documents d",
        "bad",
    ),
)

# Value sets

add(
    "value_set_check",
    table("orders"),
    ("value_set_check", "o_orderstatus", {"allowed_values": ["F", "O"]}),
    counted("SELECT o_orderstatus FROM orders", "NOT (o_orderstatus IN ('F', 'O'))"),
)
add(
    "value_set_null_value",
    documents_with_labels,
    ("value_set_check", "quality", {"allowed_values": [1]}),
    counted(DOCUMENTS_WITH_LABELS, "NOT (quality IN (1))"),
)
add(
    "value_set_null_listed",
    table("orders"),
    ("value_set_check", "o_orderstatus", {"allowed_values": ["F", None]}),
    counted("SELECT o_orderstatus FROM orders", "NOT (o_orderstatus IN ('F', NULL))"),
)
add(
    "value_set_nothing_allowed",
    documents_with_labels,
    ("value_set_check", "quality", {"allowed_values": []}),
    counted(DOCUMENTS_WITH_LABELS, "quality IS NOT NULL"),
)
add(
    "value_set_long_list",
    table("orders"),
    ("value_set_check", "o_custkey", {"allowed_values": list(range(1, 1201))}),
    counted("SELECT o_custkey FROM orders", "NOT (o_custkey BETWEEN 1 AND 1200)"),
)

add(
    "value_set_long_decimals",
    lambda t: t("orders").select((F.col("o_custkey") * F.lit(Decimal("0.5"))).alias("x")),
    ("value_set_check", "x", {"allowed_values": [Decimal(i) / 2 for i in range(1, 1201)]}),
    counted("SELECT o_custkey * 0.5 AS x FROM orders", "NOT (x BETWEEN 0.5 AND 600)"),
)
add(
    "value_set_mixed_numbers",
    lambda t: t("lineitem").select(F.col("l_quantity").cast("decimal(12,2)").alias("x")),
    ("value_set_check", "x", {"allowed_values": [Decimal("1.00"), 2, 3, Decimal("4.5")]}),
    counted(
        "SELECT CAST(l_quantity AS DECIMAL(12,2)) AS x FROM lineitem", "NOT (x IN (1, 2, 3, 4.5))"
    ),
)

# Types

add(
    "data_type_number",
    lambda t: t("part").select(
        F.when(F.col("p_size") > 45, F.concat("p_size", F.lit("e1")))
        .otherwise(F.concat(F.lit("-"), "p_size", F.lit(".5")))
        .alias("x")
    ),
    ("data_type_check", "x", {"expected_type": "number"}),
    counted(
        "SELECT CASE WHEN p_size > 45 THEN concat(p_size, 'e1') "
        "ELSE concat('-', p_size, '.5') END AS x FROM part",
        r"NOT regexp_full_match(x, '-?\d+(\.\d+)?')",
    ),
)
add(
    "data_type_number_typed",
    table("orders"),
    ("data_type_check", "o_totalprice", {"expected_type": "FLOAT"}),
    counted("SELECT o_totalprice FROM orders", "o_totalprice IS NULL"),
)
add(
    "data_type_date",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", "2024-02-30")
        .when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd"))
        .alias("x")
    ),
    ("data_type_check", "x", {"expected_type": "DATE"}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN '2024-02-30' WHEN event_type <> 'view' "
        "THEN strftime(ts, '%Y-%m-%d') END AS x FROM events",
        "x IS NOT NULL AND try_strptime(x, '%Y-%m-%d') IS NULL",
    ),
)
add(
    "data_type_timestamp",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", "2024-01-01 25:00:00")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("x")
    ),
    ("data_type_check", "x", {"expected_type": "timestamp"}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN '2024-01-01 25:00:00' "
        "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS x FROM events",
        "x IS NOT NULL AND try_strptime(x, '%Y-%m-%d %H:%M:%S') IS NULL",
    ),
)
DATES_WITH_TIME = (
    "SELECT CASE WHEN event_type = 'click' THEN '2024-02-30 10:00:00' WHEN event_type = 'view' "
    "THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS x FROM events"
)


def dates_with_time(tables: TableResolver) -> DataFrame:
    return tables("events").select(
        F.when(F.col("event_type") == "click", "2024-02-30 10:00:00")
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("x")
    )


add(
    "data_type_date_with_time",
    dates_with_time,
    ("data_type_check", "x", {"expected_type": "DATE"}),
    counted(DATES_WITH_TIME, "try_strptime(substr(x, 1, 10), '%Y-%m-%d') IS NULL"),
)
add(
    "data_type_time_only",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", F.date_format("ts", "HH:mm"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .alias("x")
    ),
    ("data_type_check", "x", {"expected_type": "TIMESTAMP"}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN strftime(ts, '%H:%M') "
        "ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS x FROM events",
        "try_strptime(x, '%Y-%m-%d %H:%M') IS NULL",
    ),
)
add(
    "data_type_string",
    lambda t: t("documents").select(
        F.when(F.col("lang") == "de", F.col("doc_id").cast("string"))
        .otherwise(F.col("text"))
        .alias("x")
    ),
    ("data_type_check", "x", {"expected_type": "VARCHAR"}),
    counted(
        "SELECT CASE WHEN lang = 'de' THEN CAST(doc_id AS VARCHAR) ELSE text END AS x "
        "FROM documents",
        r"regexp_full_match(x, '\d+')",
    ),
)

# Lengths

add(
    "length_check",
    table("documents"),
    ("length_check", "text", {"min_len": 40, "max_len": 5000}),
    counted("SELECT text FROM documents", "length(text) < 40 OR length(text) > 5000"),
)
add(
    "length_check_max",
    table("pages"),
    ("length_check", "html", {"max_len": 4000}),
    counted("SELECT html FROM pages", "length(html) > 4000"),
)

# Dates

add(
    "date_validity_check",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", "2024-02-30")
        .when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd"))
        .alias("x")
    ),
    ("date_validity_check", "x", {}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN '2024-02-30' WHEN event_type <> 'view' "
        "THEN strftime(ts, '%Y-%m-%d') END AS x FROM events",
        "try_strptime(x, '%Y-%m-%d') IS NULL",
    ),
)
add(
    "date_validity_lower_case",
    lambda t: t("events").select(
        F.when(F.col("event_type") == "click", "2024-45-10")
        .when(F.col("event_type") == "view", "2024-02-30")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("x")
    ),
    ("date_validity_check", "x", {"date_format": "yyyy-mm-dd"}),
    counted(
        "SELECT CASE WHEN event_type = 'click' THEN '2024-45-10' WHEN event_type = 'view' "
        "THEN '2024-02-30' ELSE strftime(ts, '%Y-%m-%d') END AS x FROM events",
        "try_strptime(x, '%Y-%m-%d') IS NULL",
    ),
)
add(
    "date_validity_format",
    lambda t: t("orders").select(
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("x")
    ),
    ("date_validity_check", "x", {"date_format": "DD/MM/YYYY"}),
    counted(
        "SELECT CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%m/%d/%Y') "
        "ELSE strftime(o_orderdate, '%d/%m/%Y') END AS x FROM orders",
        "try_strptime(x, '%d/%m/%Y') IS NULL",
    ),
)

# Duplicates

add(
    "duplicate_row_check",
    lambda t: t("documents").select("text", "lang"),
    ("duplicate_row_check", "text", {}),
    counted_groups("SELECT text, lang FROM documents", "text, lang"),
)
add(
    "duplicate_row_null_text",
    lambda t: t("documents").select(
        F.when(F.col("source") != "web", F.col("text")).alias("text"), "lang"
    ),
    ("duplicate_row_check", "text", {}),
    counted_groups(
        "SELECT CASE WHEN source <> 'web' THEN text END AS text, lang FROM documents", "text, lang"
    ),
)
add(
    "duplicate_row_whole_table",
    table("lineitem"),
    ("duplicate_row_check", "l_orderkey", {}),
    counted_groups(
        "SELECT * FROM lineitem",
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    ),
)
add(
    "duplicate_row_hot_groups",
    lambda t: t("lineitem").select("l_returnflag", "l_linestatus", "l_tax"),
    ("duplicate_row_check", "l_tax", {}),
    counted_groups("SELECT * FROM lineitem", "l_returnflag, l_linestatus, l_tax"),
)
add(
    "duplicate_row_narrow",
    lambda t: t("lineitem").select("l_orderkey", "l_suppkey"),
    ("duplicate_row_check", "l_orderkey", {}),
    counted_groups("SELECT l_orderkey, l_suppkey FROM lineitem", "l_orderkey, l_suppkey"),
)

# Expressions

add(
    "custom_expression_check",
    table("lineitem"),
    (
        "custom_expression_check",
        "any",
        {"expression": "l_extendedprice >= 1000 * l_quantity OR l_discount > 0.05"},
    ),
    counted(
        "SELECT * FROM lineitem",
        "NOT (l_extendedprice >= 1000 * l_quantity OR l_discount > 0.05)",
    ),
)
add(
    "custom_expression_unknown",
    documents_with_labels,
    ("custom_expression_check", "any", {"expression": "quality = 1 AND toxic = 0"}),
    counted(DOCUMENTS_WITH_LABELS, "NOT (quality = 1 AND toxic = 0)"),
)
add(
    "conditional_check",
    table("orders"),
    (
        "conditional_check",
        "any",
        {
            "condition": "o_orderstatus = 'F'",
            "col": "o_orderpriority",
            "expected_value": "1-URGENT",
        },
    ),
    counted(
        "SELECT o_orderstatus, o_orderpriority FROM orders",
        "o_orderpriority <> '1-URGENT'",
        scope="o_orderstatus = 'F'",
    ),
)
add(
    "conditional_check_never_met",
    table("orders"),
    (
        "conditional_check",
        "any",
        {"condition": "o_totalprice < 0", "col": "o_orderstatus", "expected_value": "F"},
    ),
    counted(
        "SELECT o_totalprice, o_orderstatus FROM orders",
        "o_orderstatus <> 'F'",
        scope="o_totalprice < 0",
    ),
    empty="0",
)

# Empty input, registered checks

add(
    "empty_table",
    lambda t: t("orders").where(F.col("o_totalprice") < 0),
    ("null_check", "o_custkey", {}),
    counted("SELECT o_custkey FROM orders WHERE o_totalprice < 0", "o_custkey IS NULL"),
)
add(
    "empty_table_outlier",
    lambda t: t("orders").where(F.col("o_totalprice") < 0),
    ("outlier_check", "o_custkey", {}),
    counted("SELECT o_custkey FROM orders WHERE o_totalprice < 0", "o_custkey IS NULL"),
    empty="0",
)
add(
    "registered_row_check",
    table("customer"),
    ("upper_case_check", "c_mktsegment", {}),
    counted("SELECT c_mktsegment FROM customer", "upper(c_mktsegment) <> c_mktsegment"),
)
add(
    "registered_set_check",
    table("orders"),
    ("group_total_check", "o_totalprice", {"by": "o_custkey", "most": 3_000_000}),
    "SELECT count(*) AS n, count(*) FILTER (WHERE x > 3000000) AS failed "
    "FROM (SELECT sum(o_totalprice) AS x FROM orders GROUP BY o_custkey) AS totals",
)
