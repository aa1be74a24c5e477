"""Whole configurations: many rules on several tables in one run."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.base import Query, counted, counted_groups
from plumbline import TableResolver, frames, plan_dq_from_config, run_dq_from_config

QUERIES: dict[str, Query] = {}


def _rule(dq_type: str, threshold: float = 1.0, **params: Any) -> dict[str, Any]:
    return {"dq_type": dq_type, "params": params, "threshold": threshold}


def _rated(table: str, column: str, dq_type: str, counts: str, threshold: float = 1.0) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{dq_type}' AS dq_type, "
        f"CASE WHEN (failed / n) * 100 <= {threshold} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"failed, (failed / n) * 100 AS percent, CAST(NULL AS VARCHAR) AS error "
        f"FROM ({counts}) AS c"
    )


def _zscore(table: str, column: str, z: float) -> str:
    return counted(
        f"SELECT {column} AS x, (SELECT avg({column}) FROM {table}) AS m, "
        f"(SELECT stddev_samp({column}) FROM {table}) AS s FROM {table}",
        f"abs((x - m) / s) > {z}",
    )


def _orphans(table: str, column: str, ref: str, key: str) -> str:
    return counted(
        f"SELECT NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{key} = t.{column}) AS bad "
        f"FROM {table} t",
        "bad",
    )


# Ten row rules on one table: one scan.
LINE_RULES = {
    "tables": [
        {
            "name": "lineitem",
            "columns": [
                {"name": "l_orderkey", "dq_rules": [_rule("null_check")]},
                {"name": "l_returnflag", "dq_rules": [_rule("blank_check")]},
                {
                    "name": "l_linestatus",
                    "dq_rules": [
                        _rule("regex_check", pattern="[FO]"),
                        _rule("value_set_check", 60.0, allowed_values=["O"]),
                        _rule("length_check", min_len=1, max_len=1),
                    ],
                },
                {
                    "name": "l_quantity",
                    "dq_rules": [
                        _rule("range_check", 5.0, min_val=2, max_val=49),
                        _rule("data_type_check", expected_type="NUMBER"),
                    ],
                },
                {
                    "name": "l_extendedprice",
                    "dq_rules": [_rule("cross_field_check", operator=">", col2="l_quantity")],
                },
                {
                    "name": "l_discount",
                    "dq_rules": [
                        _rule("custom_expression_check", expression="l_discount + l_tax <= 0.15"),
                        _rule(
                            "conditional_check",
                            condition="l_discount > 0.05",
                            col="l_returnflag",
                            expected_value="N",
                        ),
                    ],
                },
            ],
        }
    ]
}


def _line(column: str, dq_type: str, pred: str, threshold: float = 1.0, scope: str = "TRUE") -> str:
    return _rated(
        "lineitem", column, dq_type, counted("SELECT * FROM lineitem", pred, scope), threshold
    )


LINE_RULES_SQL = "\nUNION ALL ".join(
    [
        _line("l_orderkey", "null_check", "l_orderkey IS NULL"),
        _line("l_returnflag", "blank_check", "trim(l_returnflag) = ''"),
        _line("l_linestatus", "regex_check", "NOT regexp_full_match(l_linestatus, '[FO]')"),
        _line("l_linestatus", "value_set_check", "l_linestatus <> 'O'", 60.0),
        _line("l_linestatus", "length_check", "length(l_linestatus) <> 1"),
        _line("l_quantity", "range_check", "l_quantity < 2 OR l_quantity > 49", 5.0),
        _line("l_quantity", "data_type_check", "l_quantity IS NULL"),
        _line("l_extendedprice", "cross_field_check", "l_extendedprice <= l_quantity"),
        _line("l_discount", "custom_expression_check", "NOT (l_discount + l_tax <= 0.15)"),
        _line("l_discount", "conditional_check", "l_returnflag <> 'N'", scope="l_discount > 0.05"),
    ]
)

QUERIES["suite_row_rules"] = Query(
    lambda spark, tables: plan_dq_from_config(spark, LINE_RULES, tables), LINE_RULES_SQL
)

# Row rules, outliers, references and duplicates on four tables: one job.
WAREHOUSE = {
    "tables": [
        {
            "name": "orders",
            "columns": [
                {
                    "name": "o_totalprice",
                    "dq_rules": [
                        _rule("range_check", 12.0, min_val=10000, max_val=450000),
                        _rule("outlier_check", z_threshold=2),
                    ],
                },
                {
                    "name": "o_custkey",
                    "dq_rules": [
                        _rule("referential_check", ref_table="customer", ref_col="c_custkey"),
                        _rule("outlier_check", z_threshold=1.5),
                    ],
                },
                {
                    "name": "o_orderkey",
                    "dq_rules": [
                        _rule("referential_check", ref_table="lineitem", ref_col="l_orderkey"),
                        _rule("duplicate_row_check"),
                    ],
                },
            ],
        },
        {
            "name": "customer",
            "columns": [
                {
                    "name": "c_mktsegment",
                    "dq_rules": [_rule("value_set_check", 20.0, allowed_values=["BUILDING"])],
                },
                {
                    "name": "c_nationkey",
                    "dq_rules": [
                        _rule("referential_check", ref_table="nation", ref_col="n_nationkey")
                    ],
                },
            ],
        },
        {
            "name": "documents",
            "columns": [
                {
                    "name": "text",
                    "dq_rules": [
                        _rule("length_check", 20.0, min_len=40, max_len=5000),
                        _rule("duplicate_row_check"),
                    ],
                },
                {"name": "lang", "dq_rules": [_rule("regex_check", pattern="[a-z]{2}")]},
            ],
        },
        {
            "name": "events",
            "columns": [
                {"name": "value", "dq_rules": [_rule("outlier_check")]},
                {"name": "props", "dq_rules": [_rule("blank_check"), _rule("null_check")]},
            ],
        },
    ]
}

WAREHOUSE_SQL = "\nUNION ALL ".join(
    [
        _rated(
            "orders",
            "o_totalprice",
            "range_check",
            counted("SELECT * FROM orders", "o_totalprice < 10000 OR o_totalprice > 450000"),
            12.0,
        ),
        _rated("orders", "o_totalprice", "outlier_check", _zscore("orders", "o_totalprice", 2)),
        _rated(
            "orders",
            "o_custkey",
            "referential_check",
            _orphans("orders", "o_custkey", "customer", "c_custkey"),
        ),
        _rated("orders", "o_custkey", "outlier_check", _zscore("orders", "o_custkey", 1.5)),
        _rated(
            "orders",
            "o_orderkey",
            "referential_check",
            _orphans("orders", "o_orderkey", "lineitem", "l_orderkey"),
        ),
        _rated(
            "orders",
            "o_orderkey",
            "duplicate_row_check",
            counted_groups(
                "SELECT * FROM orders",
                "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
            ),
        ),
        _rated(
            "customer",
            "c_mktsegment",
            "value_set_check",
            counted("SELECT * FROM customer", "c_mktsegment <> 'BUILDING'"),
            20.0,
        ),
        _rated(
            "customer",
            "c_nationkey",
            "referential_check",
            _orphans("customer", "c_nationkey", "nation", "n_nationkey"),
        ),
        _rated(
            "documents",
            "text",
            "length_check",
            counted("SELECT text FROM documents", "length(text) < 40 OR length(text) > 5000"),
            20.0,
        ),
        _rated(
            "documents",
            "text",
            "duplicate_row_check",
            counted_groups("SELECT * FROM documents", "doc_id, text, lang, source, n_chars"),
        ),
        _rated(
            "documents",
            "lang",
            "regex_check",
            counted("SELECT lang FROM documents", "NOT regexp_full_match(lang, '[a-z]{2}')"),
        ),
        _rated("events", "value", "outlier_check", _zscore("events", "value", 3)),
        _rated(
            "events", "props", "blank_check", counted("SELECT props FROM events", "trim(props) = ''")
        ),
        _rated(
            "events", "props", "null_check", counted("SELECT props FROM events", "props IS NULL")
        ),
    ]
)

QUERIES["suite_warehouse"] = Query(
    lambda spark, tables: plan_dq_from_config(spark, WAREHOUSE, tables), WAREHOUSE_SQL
)
QUERIES["suite_warehouse_run"] = Query(
    lambda spark, tables: run_dq_from_config(spark, WAREHOUSE, tables), WAREHOUSE_SQL
)

# Good rules next to an unknown check (no row), a missing column, a bad type name, a missing
# table and a text that is no number: the bad ones become ERROR rows.
MIXED = {
    "tables": [
        {
            "name": "orders",
            "columns": [
                {
                    "name": "o_orderstatus",
                    "dq_rules": [
                        _rule("null_check"),
                        _rule("no_such_check"),
                        _rule("range_check", min_val=5),
                        _rule("data_type_check", expected_type="BLOB"),
                        _rule("value_set_check", 50.0, allowed_values=["F", "O"]),
                    ],
                },
                {"name": "no_such_column", "dq_rules": [_rule("null_check")]},
            ],
        },
        {"name": "no_such_table", "columns": [{"name": "x", "dq_rules": [_rule("null_check")]}]},
    ]
}


def _mixed(spark: SparkSession, tables: TableResolver) -> DataFrame:
    return run_dq_from_config(spark, MIXED, tables).select(
        "table",
        "column",
        "dq_type",
        "status",
        "failed",
        "percent",
        F.col("error").isNotNull().alias("has_error"),
    )


def _error(table: str, column: str, dq_type: str) -> str:
    return (
        f"SELECT '{table}', '{column}', '{dq_type}', 'ERROR', CAST(NULL AS BIGINT), "
        "CAST(NULL AS DOUBLE), TRUE"
    )


def _good(column: str, dq_type: str, pred: str, threshold: float = 1.0) -> str:
    rated = _rated("orders", column, dq_type, counted("SELECT * FROM orders", pred), threshold)
    return (
        'SELECT "table", "column", dq_type, status, failed, percent, FALSE AS has_error '
        f"FROM ({rated}) AS g"
    )


QUERIES["suite_isolation"] = Query(
    _mixed,
    "\nUNION ALL ".join(
        [
            _good("o_orderstatus", "null_check", "o_orderstatus IS NULL"),
            _good("o_orderstatus", "value_set_check", "NOT (o_orderstatus IN ('F', 'O'))", 50.0),
            _error("orders", "o_orderstatus", "range_check"),
            _error("orders", "o_orderstatus", "data_type_check"),
            _error("orders", "no_such_column", "null_check"),
            _error("no_such_table", "x", "null_check"),
        ]
    ),
)

# A rule whose scalar subquery fails on the data, between good ones: deviations of a text column, and
# a condition with a query of its own.
TEXT_OUTLIERS = {
    "tables": [
        {
            "name": "orders",
            "columns": [
                {
                    "name": "o_orderstatus",
                    "dq_rules": [
                        _rule("null_check"),
                        _rule("outlier_check"),
                        _rule("value_set_check", 50.0, allowed_values=["F", "O"]),
                    ],
                }
            ],
        }
    ]
}
FAILING_SUBQUERY = {
    "tables": [
        {
            "name": "orders",
            "columns": [
                {
                    "name": "o_orderstatus",
                    "dq_rules": [
                        _rule("null_check"),
                        _rule(
                            "custom_expression_check",
                            expression="o_custkey > "
                            "(SELECT min(CAST(o_orderstatus AS INT)) FROM plumbline_orders)",
                        ),
                        _rule("value_set_check", 50.0, allowed_values=["F", "O"]),
                    ],
                }
            ],
        }
    ]
}


def _flagged(spark: SparkSession, tables: TableResolver, config: dict[str, Any]) -> DataFrame:
    tables("orders").createOrReplaceTempView("plumbline_orders")
    return run_dq_from_config(spark, config, tables).select(
        "table",
        "column",
        "dq_type",
        "status",
        "failed",
        "percent",
        F.col("error").contains("CAST_INVALID_INPUT").alias("has_error"),
    ).na.fill(False, ["has_error"])


def _one_error(dq_type: str) -> str:
    return "\nUNION ALL ".join(
        [
            _good("o_orderstatus", "null_check", "o_orderstatus IS NULL"),
            _error("orders", "o_orderstatus", dq_type),
            _good("o_orderstatus", "value_set_check", "NOT (o_orderstatus IN ('F', 'O'))", 50.0),
        ]
    )


QUERIES["suite_outlier_on_text"] = Query(
    lambda spark, tables: _flagged(spark, tables, TEXT_OUTLIERS), _one_error("outlier_check")
)
QUERIES["suite_failing_subquery"] = Query(
    lambda spark, tables: _flagged(spark, tables, FAILING_SUBQUERY),
    _one_error("custom_expression_check"),
)

# Four references of one table: one scan of it.
REFERENCES = {
    "tables": [
        {
            "name": "lineitem",
            "columns": [
                {
                    "name": column,
                    "dq_rules": [_rule("referential_check", 50.0, ref_table=ref, ref_col=key)],
                }
                for column, ref, key in [
                    ("l_orderkey", "orders", "o_custkey"),
                    ("l_partkey", "part", "p_size"),
                    ("l_suppkey", "supplier", "s_suppkey"),
                    ("l_returnflag", "orders", "o_orderstatus"),
                ]
            ],
        }
    ]
}
REFERENCES_SQL = "\nUNION ALL ".join(
    _rated("lineitem", column, "referential_check", _orphans("lineitem", column, ref, key), 50.0)
    for column, ref, key in [
        ("l_orderkey", "orders", "o_custkey"),
        ("l_partkey", "part", "p_size"),
        ("l_suppkey", "supplier", "s_suppkey"),
        ("l_returnflag", "orders", "o_orderstatus"),
    ]
)
QUERIES["suite_references"] = Query(
    lambda spark, tables: plan_dq_from_config(spark, REFERENCES, tables), REFERENCES_SQL
)

# Rules that leave parameters and threshold to the defaults, on data with defects.
DEFAULTS = {
    "tables": [
        {
            "name": "defects",
            "columns": [
                {"name": "total", "dq_rules": [{"dq_type": "outlier_check"}]},
                {
                    "name": "status",
                    "dq_rules": [{"dq_type": "null_check"}, {"dq_type": "blank_check"}],
                },
                {"name": "day", "dq_rules": [{"dq_type": "date_validity_check"}]},
                {"name": "low", "dq_rules": [{"dq_type": "range_check"}]},
            ],
        }
    ]
}


def _defects(tables: TableResolver) -> DataFrame:
    orders = tables("orders")
    return orders.select(
        F.col("o_totalprice").alias("total"),
        F.when(F.col("o_custkey") % 7 == 0, " ")
        .when(F.col("o_custkey") % 11 != 0, F.col("o_orderstatus"))
        .alias("status"),
        F.when(F.col("o_orderkey") % 150 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day"),
        F.col("o_custkey").alias("low"),
    )


DEFECTS = (
    "SELECT o_totalprice AS total, CASE WHEN o_custkey % 7 = 0 THEN ' ' WHEN o_custkey % 11 <> 0 "
    "THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 150 <> 0 "
    "THEN strftime(o_orderdate, '%Y-%m-%d') END AS day, o_custkey AS low FROM orders"
)
QUERIES["suite_defaults"] = Query(
    lambda spark, tables: plan_dq_from_config(
        spark, DEFAULTS, frames({"defects": _defects(tables)}, otherwise=tables)
    ),
    "\nUNION ALL ".join(
        [
            _rated(
                "defects",
                "total",
                "outlier_check",
                counted(
                    f"SELECT total AS x, (SELECT avg(total) FROM ({DEFECTS})) AS m, "
                    f"(SELECT stddev_samp(total) FROM ({DEFECTS})) AS s FROM ({DEFECTS})",
                    "abs((x - m) / s) > 3",
                ),
            ),
            _rated("defects", "status", "null_check", counted(DEFECTS, "status IS NULL")),
            _rated("defects", "status", "blank_check", counted(DEFECTS, "trim(status) = ''")),
            _rated("defects", "day", "date_validity_check", counted(DEFECTS, "day IS NULL")),
            _rated("defects", "low", "range_check", counted(DEFECTS, "FALSE")),
        ]
    ),
)
