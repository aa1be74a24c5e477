"""Audit checks and the audit log."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from plumbline import (
    AUDIT_SCHEMA,
    AuditParams,
    check_completeness,
    check_reconciliation,
    check_timeliness,
    check_uniqueness,
    parquet_tables,
    query_history,
    run_audit_job,
    run_dq_checks,
    write_dq_results,
)

DAY = "2024-03-01"
AS_OF = datetime(2024, 3, 1, 12, 30, 5)


def brief(frame):
    return [
        (r["dq_dimension"], r["column_name"], r["status"], r["failed_rows"], r["dq_comment"])
        for r in frame.collect()
    ]


@pytest.fixture
def target(spark):
    rows = [
        (1, 10, 1.5, date(2024, 2, 28)),
        (1, 11, 2.5, date(2024, 2, 27)),
        (2, None, 3.0, None),
        (3, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "order_id int, customer_id int, amount double, edi_business_day date"
    )


def test_uniqueness(target):
    assert brief(check_uniqueness(target, ["order_id"], DAY)) == [
        ("Uniqueness", "order_id", "FAIL", 1.0, "Duplicate key rows found: 1")
    ]
    assert brief(check_uniqueness(target, ["order_id", "customer_id"], DAY)) == [
        ("Uniqueness", "order_id,customer_id", "PASS", 0.0, "Duplicate key rows found: 0")
    ]
    assert brief(check_uniqueness(target, None, DAY)) == []
    assert brief(check_uniqueness(target, [], DAY)) == []


def test_completeness(target):
    assert brief(check_completeness(target, ["order_id", "customer_id"], DAY)) == [
        ("Completeness", "order_id", "PASS", 0.0, "Null values in order_id: 0"),
        ("Completeness", "customer_id", "FAIL", 2.0, "Null values in customer_id: 2"),
    ]
    assert brief(check_completeness(target, None, DAY)) == []


def test_reconciliation_modes(target):
    source = target.na.fill({"amount": 4.0})
    assert brief(check_reconciliation(source, target, "amount", DAY)) == [
        ("Reconciliation", "amount", "FAIL", 1.0, "Non-null count check — Source: 4, Target: 3"),
        ("Reconciliation", "amount", "FAIL", 4.0, "Sum check — Source: 11.0, Target: 7.0"),
    ]
    assert brief(check_reconciliation(source, target, "order_id", DAY, mode="rows")) == [
        ("Reconciliation", "order_id", "PASS", 0.0, "Count check — Source: 4, Target: 4"),
        ("Reconciliation", "order_id", "PASS", 0.0, "Sum check — Source: 7, Target: 7"),
    ]
    assert brief(check_reconciliation(source, target, None, DAY)) == []
    assert brief(check_reconciliation(source, target, [], DAY)) == []
    with pytest.raises(TypeError):
        check_reconciliation(source, target, ["amount", 5], DAY)
    with pytest.raises(ValueError):
        check_reconciliation(source, target, ["amount"], DAY, mode="other")


def test_reconciliation_of_nothing(target):
    none = target.where("order_id > 100")
    assert brief(check_reconciliation(none, none, "amount", DAY)) == [
        ("Reconciliation", "amount", "PASS", 0.0, "Non-null count check — Source: 0, Target: 0"),
        ("Reconciliation", "amount", "PASS", 0.0, "Sum check — Source: 0.0, Target: 0.0"),
    ]


def test_tolerance(spark):
    source = spark.createDataFrame([(10.0,)], "v double")
    target = spark.createDataFrame([(10.4,)], "v double")

    def status(tolerance):
        rows = check_reconciliation(source, target, "v", DAY, tolerance=tolerance).collect()
        return rows[1]["status"]

    assert [status(0), status(0.3), status(0.5)] == ["FAIL", "FAIL", "PASS"]


def test_smallest_difference_counts(spark):
    source = spark.createDataFrame([(1e-12,), (5e9,)], "v double")
    target = spark.createDataFrame([(0.0,), (5e9,)], "v double")
    row = check_reconciliation(source, target, "v", DAY).collect()[1]
    assert (row["status"], row["failed_rows"]) == ("FAIL", 1e-12)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_values_without_sum_are_an_error(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,)], "v double")
    row = check_reconciliation(df, df, "v", DAY).collect()[1]
    assert (row["status"], row["failed_rows"]) == ("ERROR", 2.0)


def sums(spark, source, target, partitions=None, **options):
    one, two = (
        spark.createDataFrame([(v,) for v in values], f"v {kind}") for values, kind in (source, target)
    )
    if partitions:
        one, two = one.repartition(partitions), two.repartition(partitions)
    row = check_reconciliation(one, two, "v", DAY, **options).collect()[1]
    return row["status"], row["failed_rows"]


@pytest.mark.parametrize("partitions", [1, 3, 7])
@pytest.mark.parametrize("mode", ["non_null", "rows"])
@pytest.mark.parametrize(
    ("source", "target", "expected"),
    [
        (([3], "int"), ([3.04], "double"), ("FAIL", 0.04)),
        (([3], "int"), ([3.0], "double"), ("PASS", 0.0)),
        (([D("100.00")], "decimal(18,2)"), ([100.0004], "double"), ("FAIL", 0.0004)),
        (([D("0.10")] * 10, "decimal(18,2)"), ([1.0], "double"), ("PASS", 0.0)),
        (([1], "long"), ([D("1.0000001")], "decimal(38,10)"), ("FAIL", 1e-7)),
        (([D("1.00")], "decimal(12,2)"), ([D("1.0000001")], "decimal(20,8)"), ("FAIL", 1e-7)),
        (([1e27] * 3, "double"), ([3e27], "double"), ("PASS", 0.0)),
        (([1e27], "double"), ([D(10**27)], "decimal(38,0)"), ("PASS", 0.0)),
        (([1e-13] * 1000, "double"), ([0.0] * 1000, "double"), ("FAIL", 1e-10)),
        (
            ([D("12345678." + "0" * 29 + "1")], "decimal(38,30)"),
            ([D("12345678." + "0" * 29 + "1")], "decimal(38,30)"),
            ("PASS", 0.0),
        ),
        (
            ([D("12345678." + "0" * 29 + "1")], "decimal(38,30)"),
            ([12345678], "int"),
            ("FAIL", 1e-30),
        ),
        (([1.5], "float"), ([D("1.5")], "decimal(2,1)"), ("PASS", 0.0)),
    ],
)
def test_unlike_types_are_compared_exactly(spark, source, target, expected, mode, partitions):
    assert sums(spark, source, target, partitions, mode=mode) == expected


def test_tolerance_across_types(spark):
    assert sums(spark, ([3], "int"), ([3.04], "double"), tolerance=0.04)[0] == "PASS"
    assert sums(spark, ([3], "int"), ([3.04], "double"), tolerance=0.039)[0] == "FAIL"


def ran(frame):
    """Lines of the physical plan as it ran, subqueries included."""
    frame.collect()
    kept, skipped = [], None
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and indent >= skipped:
            continue
        skipped = indent if "== Initial Plan ==" in line else None
        kept.append(line)
    return kept


def heavy_aggregates(frame):
    """Aggregations over the table's rows: how many are compiled, how many are not."""
    lines = [x for x in ran(frame) if "Aggregate(" in x and "partial_count" in x]
    return sum("*(" in x for x in lines), sum("*(" not in x for x in lines)


def test_wide_audits_are_compiled(spark):
    wide = spark.range(50).select(*[(F.col("id") / (i + 3)).alias(f"c{i}") for i in range(30)])
    names = wide.columns
    found = check_reconciliation(wide, wide, names, DAY)
    compiled, interpreted = heavy_aggregates(found)
    assert compiled >= 10 and interpreted == 0
    assert {r["status"] for r in found.collect()} == {"PASS"}
    many = spark.range(50).select(
        *[F.when(F.col("id") % (i + 2) != 0, F.col("id")).alias(f"c{i}") for i in range(300)]
    )
    found = check_completeness(many, many.columns, DAY)
    compiled, interpreted = heavy_aggregates(found)
    assert compiled >= 4 and interpreted == 0
    expected = [float(sum(k % (i + 2) == 0 for k in range(50))) for i in range(300)]
    assert [r["failed_rows"] for r in found.collect()] == expected


def test_integers_and_decimals_reconcile(spark):
    source = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "v long")
    target = source.select(F.col("v").cast("decimal(30,2)").alias("v"))
    assert [r["status"] for r in check_reconciliation(source, target, "v", DAY).collect()] == [
        "PASS",
        "PASS",
    ]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_sums_do_not_depend_on_partitioning(spark, sf_dir, partitions):
    lines = parquet_tables(spark, sf_dir)("lineitem")
    other = lines.repartition(partitions, "l_suppkey")
    columns = ["l_extendedprice", "l_discount", "l_tax"]
    rows = check_reconciliation(lines, other, columns, DAY).collect()
    assert {r["status"] for r in rows} == {"PASS"}


@pytest.mark.parametrize(
    ("as_of", "lag", "status", "days"),
    [
        (date(2024, 3, 1), 2, "PASS", 2.0),
        (date(2024, 3, 2), 2, "FAIL", 3.0),
        (date(2024, 3, 2), 3, "PASS", 3.0),
        (date(2024, 2, 27), 0, "PASS", -1.0),
    ],
)
def test_timeliness(target, as_of, lag, status, days):
    ((_, column, got, failed, comment),) = brief(check_timeliness(target, DAY, lag, as_of=as_of))
    assert (column, got, failed) == ("edi_business_day", status, days)
    assert comment == f"Latest date: 2024-02-28, lag days: {int(days)}"


def test_timeliness_needs_a_date(target):
    assert brief(check_timeliness(target.drop("edi_business_day"), DAY)) == []
    assert brief(check_timeliness(target.where("order_id > 1"), DAY)) == []
    text = target.withColumn("edi_business_day", F.col("edi_business_day").cast("string"))
    assert brief(check_timeliness(text, DAY, as_of=AS_OF))[0][2] == "PASS"


def test_run_keeps_the_order(target):
    records = run_dq_checks(
        target, target, DAY, ["order_id"], ["amount"], "amount", as_of=AS_OF
    ).collect()
    assert [r["dq_dimension"] for r in records] == [
        "Uniqueness",
        "Completeness",
        "Reconciliation",
        "Reconciliation",
        "Timeliness",
    ]
    assert {r["audit_timestamp"] for r in records} == {"2024-03-01 12:30:05"}
    assert {r["edi_business_day"] for r in records} == {DAY}
    assert records[-1]["failed_rows"] == 2


def test_run_takes_three_scans(spark, sf_dir):
    """The target once for all aggregates and once for its keys, the source once."""
    orders = parquet_tables(spark, sf_dir)("orders").withColumn(
        "edi_business_day", F.col("o_orderdate")
    )
    frame = run_dq_checks(
        orders,
        orders,
        DAY,
        ["o_orderkey"],
        ["o_orderkey", "o_custkey", "o_orderdate"],
        ["o_totalprice", "o_custkey"],
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line for line in plan.splitlines()) == 3


def test_run_with_nothing_to_check(target):
    bare = target.drop("edi_business_day")
    frame = run_dq_checks(bare, bare, DAY)
    assert frame.count() == 0
    assert frame.schema.names == AUDIT_SCHEMA.names


def test_times_are_utc(target):
    east = datetime(2024, 3, 1, 1, 0, tzinfo=timezone(timedelta(hours=5)))
    row = check_timeliness(target, DAY, as_of=east).first()
    assert (row["audit_timestamp"], row["failed_rows"]) == ("2024-02-29 20:00:00", 1.0)


def test_job_appends_to_the_log(spark, target, tmp_path):
    path = str(tmp_path / "audit")
    parameters = {"edi_business_day": DAY, "dq_audit_path": path, "expected_lag_days": "3"}
    first = run_audit_job(target, target, parameters, as_of=AS_OF)
    records = [r.asDict() for r in run_dq_checks(target, target, DAY, ["order_id"]).collect()]
    second = write_dq_results(spark, records, path)
    back = spark.read.parquet(path)
    assert first.count() == 6
    assert back.count() == first.count() + second.count()
    assert [(f.name, f.dataType) for f in back.schema] == [
        (f.name, f.dataType) for f in AUDIT_SCHEMA
    ]
    assert sorted(back.where("audit_timestamp = '2024-03-01 12:30:05'").collect()) == sorted(
        first.collect()
    )


def test_job_parameters():
    params = AuditParams.of({"edi_business_day": DAY, "dq_audit_path": "p", "expected_lag_days": "4"})
    assert params.expected_lag_days == 4
    assert params.primary_key_columns == ["order_id"]
    assert params.not_null_columns == ["customer_id", "amount"]
    assert params.value_column == "amount"
    with pytest.raises(KeyError, match="dq_audit_path"):
        AuditParams.of({"edi_business_day": DAY})


@pytest.mark.parametrize("time_type", ["timestamp", "timestamp_ntz"])
def test_query_history(spark, time_type):
    rows = [
        ("1", "db", "2024-03-01 00:00:00", "select 1 from a"),
        ("2", "db", "2024-03-02 00:00:00", "show tables"),
        ("3", "db", "2024-02-29 23:59:59", "select 1 from too_early"),
        ("4", "db", "2024-03-02 00:00:01", "select 1 from too_late"),
        ("5", "other", "2024-03-01 10:00:00", "select 1 from b"),
        ("0", "db", "2024-03-01 00:00:00", "select 1 from c JOIN d"),
    ]
    log = spark.createDataFrame(
        rows, "query_id string, database_name string, start_time string, query_text string"
    ).selectExpr(
        "*  EXCEPT (start_time)",
        f"CAST(start_time AS {time_type}) AS start_time",
        "'u' AS user_name",
        "'s' AS schema_name",
        "'w' AS warehouse_name",
        "7 AS execution_time",
    )
    assert query_history(log, "db").count() == 0  # nothing started since yesterday
    east = datetime(2024, 3, 2, 5, 0, tzinfo=timezone(timedelta(hours=5)))
    assert query_history(log, "db", east).count() == 3
    report = query_history(log, "db", datetime(2024, 3, 2))
    assert [(r["query_id"], r["table_name"]) for r in report.collect()] == [
        ("2", None),
        ("0", "c"),
        ("1", "a"),
    ]
    assert report.columns == [
        "query_id",
        "user_name",
        "database_name",
        "schema_name",
        "warehouse_name",
        "start_time",
        "execution_time",
        "table_name",
        "query_text",
    ]


def test_query_window_reaches_the_scan(spark, sf_dir):
    from catalogue.logs import event_log

    report = query_history(event_log(parquet_tables(spark, sf_dir)), "WEB", datetime(2024, 1, 15))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-14" in plan
    assert "LessThanOrEqual(ts,2024-01-15" in plan
