"""Source-to-target audits.

The source is ``orders`` as written; the target is what reached the lines: orders without a
line are missing, and the price of partly delivered orders is not filled in yet.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import Query, shared_folder
from plumbline import (
    TableResolver,
    check_completeness,
    check_reconciliation,
    check_timeliness,
    check_uniqueness,
    run_audit_job,
    run_dq_checks,
)
from plumbline.functions import exact_sums

QUERIES: dict[str, Query] = {}

BUSINESS_DAY = "2001-08-05"
AS_OF = date(2001, 8, 5)
STAMP = "'2001-08-05 00:00:00' AS audit_timestamp"
DAY = "'2001-08-05' AS edi_business_day"


def source_orders(tables: TableResolver) -> DataFrame:
    return tables("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("edi_business_day"),
    )


def target_orders(tables: TableResolver) -> DataFrame:
    lines = tables("lineitem").select(F.col("l_orderkey").alias("order_id"))
    return (
        source_orders(tables)
        .join(lines, "order_id", "left_semi")
        .withColumn("amount", F.when(F.col("order_status") != "P", F.col("amount")))
    )


SOURCE = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount, "
    "o_orderdate AS edi_business_day FROM orders"
)
TARGET = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS amount, "
    "o_orderdate AS edi_business_day FROM orders "
    "WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"
)
SIDES = f"WITH source AS ({SOURCE}), target AS ({TARGET})"


def record(dimension: str, column: str, status: str, failed: str, comment: str, of: str) -> str:
    return (
        f"SELECT {STAMP}, '{dimension}' AS dq_dimension, '{column}' AS column_name, "
        f"{status} AS status, CAST({failed} AS DOUBLE) AS failed_rows, {DAY}, "
        f"{comment} AS dq_comment FROM ({of}) AS m"
    )


def if_zero(value: str) -> str:
    return f"CASE WHEN {value} = 0 THEN 'PASS' ELSE 'FAIL' END"


def uniqueness_sql(base: str, keys: str) -> str:
    return record(
        "Uniqueness",
        keys,
        if_zero("d"),
        "d",
        "'Duplicate key rows found: ' || d",
        f"SELECT count(*) FILTER (WHERE c > 1) AS d "
        f"FROM (SELECT count(*) AS c FROM {base} GROUP BY {keys}) AS g",
    )


def completeness_sql(base: str, column: str) -> str:
    return record(
        "Completeness",
        column,
        if_zero("d"),
        "d",
        f"'Null values in {column}: ' || d",
        f"SELECT count(*) FILTER (WHERE {column} IS NULL) AS d FROM {base}",
    )


def count_sql(column: str, what: str, label: str) -> str:
    return record(
        "Reconciliation",
        column,
        if_zero("s - t"),
        "abs(s - t)",
        f"'{label} — Source: ' || s || ', Target: ' || t",
        f"SELECT (SELECT count({what}) FROM source) AS s, (SELECT count({what}) FROM target) AS t",
    )


def sum_sql(column: str, sql_type: str, float_text: bool) -> str:
    """Exact decimal sums; the text is the shortest one that a double of that value has."""
    text = "CAST(CAST({0} AS DOUBLE) AS VARCHAR)" if float_text else "CAST({0} AS VARCHAR)"
    return record(
        "Reconciliation",
        column,
        if_zero("s - t"),
        "abs(s - t)",
        f"'Sum check — Source: ' || {text.format('s')} || ', Target: ' || {text.format('t')}",
        f"SELECT (SELECT sum(CAST({column} AS {sql_type})) FROM source) AS s, "
        f"(SELECT sum(CAST({column} AS {sql_type})) FROM target) AS t",
    )


def timeliness_sql(base: str, lag: int) -> str:
    return record(
        "Timeliness",
        "edi_business_day",
        f"CASE WHEN d <= {lag} THEN 'PASS' ELSE 'FAIL' END",
        "d",
        "'Latest date: ' || latest || ', lag days: ' || d",
        "SELECT latest, date_diff('day', latest, DATE '2001-08-05') AS d FROM "
        f"(SELECT max(CAST(edi_business_day AS DATE)) AS latest FROM {base}) AS x",
    )


def sides_sql(*selects: str) -> str:
    return SIDES + "\n" + "\nUNION ALL ".join(selects)


def non_null_sql(column: str, sql_type: str) -> list[str]:
    return [
        count_sql(column, column, "Non-null count check"),
        sum_sql(column, sql_type, float_text=True),
    ]


MONEY = "DECIMAL(38, 6)"

QUERIES["uniqueness"] = Query(
    lambda spark, t: check_uniqueness(
        t("lineitem"), ["l_orderkey", "l_linenumber"], BUSINESS_DAY, as_of=AS_OF
    ),
    uniqueness_sql("lineitem", "l_orderkey, l_linenumber").replace(
        "'l_orderkey, l_linenumber' AS column_name", "'l_orderkey,l_linenumber' AS column_name"
    ),
)
QUERIES["uniqueness_text_key"] = Query(
    lambda spark, t: check_uniqueness(t("documents"), ["text"], BUSINESS_DAY, as_of=AS_OF),
    uniqueness_sql("documents", "text"),
)
QUERIES["uniqueness_pass"] = Query(
    lambda spark, t: check_uniqueness(source_orders(t), ["order_id"], BUSINESS_DAY, as_of=AS_OF),
    sides_sql(uniqueness_sql("source", "order_id")),
)
QUERIES["completeness"] = Query(
    lambda spark, t: check_completeness(
        t("documents").join(t("labels"), "doc_id", "left"),
        ["doc_id", "text", "quality", "toxic"],
        BUSINESS_DAY,
        as_of=AS_OF,
    ),
    "WITH base AS (SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id)\n"
    + "\nUNION ALL ".join(
        completeness_sql("base", c) for c in ["doc_id", "text", "quality", "toxic"]
    ),
)
QUERIES["reconciliation"] = Query(
    lambda spark, t: check_reconciliation(
        source_orders(t), target_orders(t), ["amount", "customer_id"], BUSINESS_DAY, as_of=AS_OF
    ),
    sides_sql(*non_null_sql("amount", MONEY), *non_null_sql("customer_id", "DECIMAL(38, 0)")),
)
QUERIES["reconciliation_rows"] = Query(
    lambda spark, t: check_reconciliation(
        source_orders(t), target_orders(t), "amount", BUSINESS_DAY, mode="rows", as_of=AS_OF
    ),
    sides_sql(count_sql("amount", "*", "Count check"), sum_sql("amount", MONEY, True)),
)
QUERIES["reconciliation_rows_integer"] = Query(
    lambda spark, t: check_reconciliation(
        source_orders(t), target_orders(t), "customer_id", BUSINESS_DAY, mode="rows", as_of=AS_OF
    ),
    sides_sql(
        count_sql("customer_id", "*", "Count check"),
        sum_sql("customer_id", "DECIMAL(38, 0)", False),
    ),
)


def _same_lines(spark: SparkSession, tables: TableResolver) -> DataFrame:
    """A table against its own rows in another order and partitioning must reconcile."""
    lines = tables("lineitem")
    return check_reconciliation(
        lines,
        lines.repartition("l_suppkey"),
        ["l_extendedprice", "l_tax"],
        BUSINESS_DAY,
        as_of=AS_OF,
    )


QUERIES["reconciliation_reordered"] = Query(
    _same_lines,
    "WITH source AS (SELECT * FROM lineitem), target AS (SELECT * FROM lineitem)\n"
    + "\nUNION ALL ".join(
        non_null_sql("l_extendedprice", MONEY) + non_null_sql("l_tax", MONEY)
    ),
)


def _source_sum(spark: SparkSession, tables: TableResolver) -> DataFrame:
    total = exact_sums(tables("orders"), ["o_totalprice"])
    return total.selectExpr("CAST(CAST(o_totalprice AS DECIMAL(38, 6)) AS STRING) AS src_sum")


QUERIES["reconciliation_sum"] = Query(
    _source_sum,
    "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(38, 6))) AS VARCHAR) AS src_sum FROM orders",
)


def _unlike(name: str, source: str, target: str, changed: str, sql_type: str) -> None:
    """Both modes of sums over unlike types: SQL for the value of one side, of the other, and of
    the other with a small difference in one row."""
    for mode in ("non_null", "rows"):
        label, what = ("Non-null count check", "v") if mode == "non_null" else ("Count check", "*")

        def run(spark: SparkSession, tables: TableResolver, mode: str = mode) -> DataFrame:
            orders = tables("orders").withColumn("first", F.expr("o_orderkey = 1"))
            one = orders.selectExpr(f"{source} AS v", f"{source} AS w")
            other = f"CASE WHEN first THEN {changed} ELSE {target} END"
            two = orders.selectExpr(f"{target} AS v", f"{other} AS w")
            found = check_reconciliation(one, two, ["v", "w"], BUSINESS_DAY, mode=mode, as_of=AS_OF)
            return found.drop("dq_comment")

        sides = (
            f"WITH source AS (SELECT {source} AS v, {source} AS w FROM orders), target AS "
            f"(SELECT {target} AS v, CASE WHEN o_orderkey = 1 THEN {changed} ELSE {target} END AS w "
            "FROM orders)\n"
        )
        selects = [
            sql
            for column in ("v", "w")
            for sql in (
                count_sql(column, column if what == "v" else what, label),
                sum_sql(column, sql_type, False),
            )
        ]
        every = "\nUNION ALL ".join(selects)
        QUERIES[f"{name}_{mode}" if mode == "rows" else name] = Query(
            run, f"{sides}SELECT * EXCLUDE (dq_comment) FROM ({every}) AS r"
        )


_unlike(
    "reconciliation_int_double",
    "CAST(o_custkey AS INT)",
    "CAST(o_custkey AS DOUBLE)",
    "CAST(CAST(o_custkey + 0.04 AS DECIMAL(20, 2)) AS DOUBLE)",
    "DECIMAL(38, 6)",
)
_unlike(
    "reconciliation_decimal_double",
    "CAST(o_totalprice AS DECIMAL(18, 2))",
    "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE)",
    "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) + CAST(0.0004 AS DECIMAL(8, 4)) AS DOUBLE)",
    "DECIMAL(38, 6)",
)
_unlike(
    "reconciliation_decimal_scales",
    "CAST(o_totalprice AS DECIMAL(12, 2))",
    "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(38, 10))",
    "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(38, 10)) "
    "+ CAST(0.0000001 AS DECIMAL(10, 10))",
    "DECIMAL(38, 10)",
)



# Doubles of up to 17 digits, tiny and large ones among them.
RANDOM_DOUBLES = {
    "x": ("l_extendedprice / 7", "DECIMAL(38, 18)"),
    "y": ("l_discount * l_tax / 3e9", "DECIMAL(38, 33)"),
    "z": ("l_extendedprice * 1e13 / (l_quantity + 6)", "DECIMAL(38, 10)"),
    "w": ("l_extendedprice / 7 + (l_orderkey = 1)::INT * 0.0009765625", "DECIMAL(38, 18)"),
}


def _doubles(spark: SparkSession, tables: TableResolver) -> DataFrame:
    """Equal in any order of the rows; ``w`` is a little more on one side."""
    x, y, z = (RANDOM_DOUBLES[c][0] for c in "xyz")
    more = "CASE WHEN l_orderkey = 1 THEN 0.0009765625D ELSE 0D END"
    lines = tables("lineitem")
    source = lines.selectExpr(f"{x} AS x", f"{y} AS y", f"{z} AS z", f"{x} AS w")
    target = lines.repartition("l_orderkey").selectExpr(
        f"{x} AS x", f"{y} AS y", f"{z} AS z", f"{x} + {more} AS w"
    )
    found = check_reconciliation(source, target, list("xyzw"), BUSINESS_DAY, as_of=AS_OF)
    return found.where("dq_comment LIKE 'Sum check%'").select("column_name", "status")


def _doubles_sql(column: str) -> str:
    value, sql_type = RANDOM_DOUBLES[column]
    other = RANDOM_DOUBLES["x" if column == "w" else column][0]
    one, two = (f"sum(CAST(CAST({v} AS VARCHAR) AS {sql_type}))" for v in (value, other))
    return (
        f"SELECT '{column}' AS column_name, CASE WHEN {one} = {two} THEN 'PASS' ELSE 'FAIL' END "
        "AS status FROM lineitem"
    )


QUERIES["reconciliation_random_doubles"] = Query(
    _doubles, "\nUNION ALL ".join(_doubles_sql(c) for c in RANDOM_DOUBLES)
)

QUERIES["timeliness"] = Query(
    lambda spark, t: check_timeliness(source_orders(t), BUSINESS_DAY, as_of=AS_OF),
    sides_sql(timeliness_sql("source", 2)),
)
QUERIES["timeliness_lag"] = Query(
    lambda spark, t: check_timeliness(target_orders(t), BUSINESS_DAY, 10, as_of=AS_OF),
    sides_sql(timeliness_sql("target", 10)),
)

AUDIT_SQL = sides_sql(
    uniqueness_sql("target", "order_id"),
    completeness_sql("target", "customer_id"),
    completeness_sql("target", "amount"),
    *non_null_sql("amount", MONEY),
    timeliness_sql("target", 2),
)


def _audit(spark: SparkSession, tables: TableResolver) -> DataFrame:
    return run_dq_checks(
        source_orders(tables),
        target_orders(tables),
        BUSINESS_DAY,
        ["order_id"],
        ["customer_id", "amount"],
        "amount",
        as_of=AS_OF,
    )


QUERIES["audit"] = Query(_audit, AUDIT_SQL)


def _audit_log(spark: SparkSession, tables: TableResolver) -> DataFrame:
    """Run the audit job with its defaults twice and read the log back."""
    path = f"{shared_folder(spark)}/audit"
    parameters = {"edi_business_day": BUSINESS_DAY, "dq_audit_path": path}
    for _ in range(2):
        run_audit_job(source_orders(tables), target_orders(tables), parameters, as_of=AS_OF)
    return spark.read.parquet(path)


QUERIES["audit_log"] = Query(
    _audit_log, f"SELECT a.* FROM ({AUDIT_SQL}) AS a, (VALUES (1), (2)) AS runs(run)"
)
