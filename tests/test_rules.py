"""Truth tables: small literal frames per check, nulls, empty values and bounds included."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline import frames, run_check
from plumbline.operators import duplicates
from plumbline.operators.duplicates import duplicate_groups


def failed(df, dq_type, column="x", **params):
    return run_check(df, dq_type, column, **params).first()["failed"]


def column_of(spark, values, data_type="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {data_type}")


@pytest.mark.parametrize(
    ("dq_type", "values", "data_type", "params", "expected"),
    [
        ("null_check", ["a", "", None, None], "string", {}, 2),
        ("blank_check", ["a", "", "  ", None, " a ", "\t"], "string", {}, 2),
        ("regex_check", ["123", "abc123", "123\n", None, ""], "string", {"pattern": r"\d+"}, 3),
        ("regex_check", ["a|b", "a", "b", "ab"], "string", {"pattern": "a|b"}, 2),
        ("regex_check", ["ABC", "abc1"], "string", {"pattern": "(?i)abc"}, 1),
        (
            "regex_check",
            ["123", "abc123", "x", None],
            "string",
            {"pattern": r"\d+", "full_match": False},
            1,
        ),
        ("range_check", [1, 2, 3, 4, None], "int", {"min_val": 2, "max_val": 3}, 2),
        ("range_check", [1, 2, 3, None], "int", {"min_val": 0, "max_val": 0}, 3),
        ("range_check", [1, 2, 3, None], "int", {"max_val": 1}, 2),
        ("range_check", [1, 2, None], "int", {}, 0),
        ("length_check", ["", "ab", "abc", "äöü", None], "string", {"min_len": 1, "max_len": 2}, 3),
        ("length_check", ["", "ab"], "string", {}, 0),
        ("value_set_check", ["a", "b", None], "string", {"allowed_values": ["a"]}, 1),
        ("value_set_check", ["a", "b", None], "string", {"allowed_values": []}, 2),
        ("value_set_check", ["a", "b", None], "string", {"allowed_values": ["a", None]}, 0),
        (
            "data_type_check",
            ["1", "-1", "1.5", "+1", ".5", "1.", "1e3", "", "1\n", None],
            "string",
            {"expected_type": "Integer"},
            6,
        ),
        ("data_type_check", [1e10, 2.5, None], "double", {"expected_type": "FLOAT"}, 0),
        (
            "data_type_check",
            ["2024-02-29", "2024-02-30", "20240228", "x", "", None],
            "string",
            {"expected_type": "date"},
            4,
        ),
        (
            "data_type_check",
            ["2024-02-29 10:00:00", "2024-02-29T10:00:00", "2024-02-29", "2024-02-29 25:00:00", None],
            "string",
            {"expected_type": "timestamp"},
            1,
        ),
        *[
            (
                "data_type_check",
                ["10:00", "T10:00", "2024", "2024-02", "2024-02-29 10:00:00", "2024-2-9", None],
                "string",
                {"expected_type": name},
                4,
            )
            for name in ("DATE", "TIMESTAMP")
        ],
        ("data_type_check", [date(2024, 1, 1), None], "date", {"expected_type": "date"}, 0),
        ("data_type_check", ["12", "12a", "2024-01-01", None], "string", {"expected_type": "text"}, 1),
        ("data_type_check", [12, -3, None], "int", {"expected_type": "string"}, 1),
        (
            "date_validity_check",
            ["2024-02-29", "2024-02-30", "2024-13-01", "x", "", None],
            "string",
            {},
            5,
        ),
        (
            "date_validity_check",
            ["29.02.2024", "2024-02-29", None],
            "string",
            {"date_format": "dd.MM.yyyy"},
            2,
        ),
        ("outlier_check", [1.0] * 20 + [1000.0, None], "double", {}, 1),
        ("outlier_check", [5.0, 5.0, 5.0], "double", {}, 0),
        ("outlier_check", [5.0], "double", {}, 0),
        ("outlier_check", [1.0] * 20 + [1000.0, float("nan")], "double", {}, 0),
        ("outlier_check", [1, 1, 1, 1, 5], "int", {"z_threshold": 1.5}, 1),
    ],
)
def test_single_column(spark, dq_type, values, data_type, params, expected):
    assert failed(column_of(spark, values, data_type), dq_type, **params) == expected


@pytest.mark.parametrize(
    ("operator", "expected"),
    [(">", 2), ("<", 2), ("=", 2), ("==", 2), (">=", 1), ("<=", 1), ("!=", 1), ("<>", 1)],
)
def test_cross_field(spark, operator, expected):
    pairs = [(1, 1), (2, 1), (1, 2), (None, 1), (1, None), (None, None)]
    df = spark.createDataFrame(pairs, "x int, y int")
    assert failed(df, "cross_field_check", operator=operator, col2="y") == expected


def test_cross_field_refuses_unknown_operator(spark):
    df = spark.createDataFrame([(1, 1)], "x int, y int")
    with pytest.raises(ValueError, match="Unsupported operator"):
        run_check(df, "cross_field_check", "x", operator="~", col2="y")


def test_unknown_type_name(spark):
    with pytest.raises(ValueError, match="Unsupported expected_type: BLOB"):
        run_check(column_of(spark, ["a"]), "data_type_check", "x", expected_type="blob")


def test_expression_passes_unknown(spark):
    df = column_of(spark, [1, 5, None], "int")
    assert failed(df, "custom_expression_check", expression="x > 3") == 1


def test_conditional_counts_rows_in_scope(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", None), ("b", 2), (None, 2)], "k string, x int"
    )
    params = {"condition": "k = 'a'", "col": "x", "expected_value": 1}
    row = run_check(df, "conditional_check", **params).first()
    assert (row["failed"], row["percent"]) == (1, pytest.approx(100 / 3))
    nobody = run_check(df, "conditional_check", **{**params, "condition": "k = 'z'"}).first()
    assert (nobody["failed"], nobody["percent"]) == (0, 0.0)


@pytest.mark.parametrize("dq_type", ["null_check", "blank_check", "duplicate_row_check"])
def test_no_percentage_of_nothing(spark, dq_type):
    row = run_check(column_of(spark, []), dq_type, "x").first()
    assert (row["failed"], row["percent"]) == (0, None)


def test_outliers_of_nothing(spark):
    row = run_check(column_of(spark, [], "double"), "outlier_check", "x").first()
    assert (row["failed"], row["percent"]) == (0, 0.0)


class TestReferences:
    def check(self, df, ref):
        tables = frames({"ref": ref})
        row = run_check(
            df, "referential_check", "x", tables=tables, ref_table="ref", ref_col="k"
        ).first()
        return row["failed"], row["percent"]

    def test_null_fails_even_with_null_key(self, spark):
        ref = spark.createDataFrame([(1,), (None,)], "k int")
        assert self.check(column_of(spark, [1, 2, None], "int"), ref) == (
            2,
            pytest.approx(200 / 3),
        )

    def test_repeated_keys_count_once(self, spark):
        ref = spark.createDataFrame([(1,), (1,), (1,)], "k long")
        assert self.check(column_of(spark, [1, 1, 3], "int"), ref)[0] == 1

    def test_same_column_name_on_both_sides(self, spark):
        df = spark.createDataFrame([(1,), (2,)], "k int")
        tables = frames({"ref": df.where("k = 1")})
        row = run_check(
            df, "referential_check", "k", tables=tables, ref_table="ref", ref_col="k"
        ).first()
        assert row["failed"] == 1

    def test_no_keys(self, spark):
        ref = spark.createDataFrame([], "k int")
        assert self.check(column_of(spark, [1, None], "int"), ref) == (2, 100.0)

    def test_hot_value_without_broadcast(self, spark):
        """A value of a third of the rows, joined by sort-merge."""
        df = spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("x")
        )
        ref = spark.range(0, 30_000, 2).select(F.col("id").alias("k"))
        ids = range(30_000)
        expected = sum(1 for i in ids if i % 3 == 0 or i % 2 == 1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert self.check(df, ref)[0] == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    ("value_type", "make"),
    [
        ("string", str),
        ("int", int),
        ("long", int),
        ("double", float),
        ("double", int),
        ("decimal(38,0)", lambda i: Decimal(10**25 + i)),
        ("decimal(12,2)", lambda i: Decimal(i) / 2 if i % 2 else i),
        ("date", lambda i: date(2000, 1, 1) + timedelta(days=i)),
    ],
)
def test_length_of_the_list_does_not_matter(spark, value_type, make):
    typed = {"double": float, "decimal(12,2)": Decimal}.get(value_type, lambda x: x)
    values = [typed(make(i)) for i in (0, 5, 998, 1000, 2000)] + [None]
    df = column_of(spark, values, value_type)
    assert failed(df, "value_set_check", allowed_values=[make(i) for i in range(999)]) == 2
    assert failed(df, "value_set_check", allowed_values=[make(i) for i in range(1001)]) == 1


@pytest.mark.parametrize(
    ("values", "value_type", "keys", "key_type", "expected"),
    [
        (["1", "2", None], "string", [1, 3], "int", 2),
        ([1.0, 2.5], "double", [1, 3], "long", 1),
        ([date(2024, 1, 1), date(2024, 1, 2)], "date", [datetime(2024, 1, 1)], "timestamp", 1),
        ([float("nan"), -0.0], "double", [float("nan"), 0.0], "double", 0),
    ],
)
def test_keys_of_another_type_meet_as_in_a_join(
    spark, values, value_type, keys, key_type, expected
):
    df = column_of(spark, values, value_type)
    ref = spark.createDataFrame([(k,) for k in keys], f"k {key_type}")
    assert df.join(ref, df["x"] == ref["k"], "left_anti").count() == expected
    tables = frames({"ref": ref})
    row = run_check(df, "referential_check", "x", tables=tables, ref_table="ref", ref_col="k")
    assert row.first()["failed"] == expected


def test_long_texts_meet_by_digest(spark):
    long = "x" * 33
    df = column_of(spark, [long, long + "y", "short", "x" * 32, "", None])
    ref = spark.createDataFrame([(long,), ("x" * 32,), ("",), ("z",)], "k string")
    row = run_check(
        df, "referential_check", "x", tables=frames({"ref": ref}), ref_table="ref", ref_col="k"
    ).first()
    assert row["failed"] == 3


class TestDuplicates:
    ROWS = [
        ("a", 1, 0.0),
        ("a", 1, -0.0),
        ("a", 2, 1.0),
        (None, 1, float("nan")),
        (None, 1, float("nan")),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        ("", None, None),
    ]

    @pytest.mark.parametrize("strategy", ["direct", "fingerprint", "auto"])
    def test_groups_not_rows(self, spark, strategy):
        df = spark.createDataFrame(self.ROWS, "count string, n int, v double")
        row = duplicate_groups(df, df.columns, strategy).first()
        assert (row["failed"], row["total"]) == (3, 9)

    def test_null_places_do_not_collide(self, spark):
        """Rows that hash alike, because nulls leave the hash as it is, stay apart."""
        df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
        assert df.select(F.xxhash64("a", "b").alias("h")).distinct().count() == 1
        row = duplicate_groups(df, ["a", "b"], "fingerprint").first()
        assert (row["failed"], row["total"]) == (0, 2)

    @pytest.mark.parametrize("strategy", ["direct", "fingerprint"])
    def test_empty(self, spark, strategy):
        df = spark.createDataFrame([], "a int, b string")
        row = duplicate_groups(df, ["a", "b"], strategy).first()
        assert (row["failed"], row["total"]) == (0, 0)

    def test_texts_equal_by_collation(self, spark):
        df = spark.sql(
            "SELECT CAST(c AS STRING COLLATE UTF8_LCASE) AS c, d FROM VALUES ('A', 'x'), ('a', 'x') "
            "AS t(c, d)"
        )
        assert duplicate_groups(df, df.columns).first()["failed"] == 1

    def test_map_column(self, spark):
        df = spark.sql("SELECT map('a', 1) AS m, 'x' AS t FROM range(2)")
        assert duplicate_groups(df, df.columns).first()["failed"] == 1

    @pytest.mark.parametrize("strategy", ["direct", "fingerprint"])
    def test_hot_group_and_very_many_groups(self, spark, strategy):
        """A third of the rows in one group, and more than 2^19 pairs."""
        pairs = 2**19 + 1000
        df = spark.range(3 * pairs).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % pairs).alias("a"),
            F.lit("same").alias("b"),
        )
        row = duplicate_groups(df, df.columns, strategy).first()
        ids = np.arange(3 * pairs)
        _, counts = np.unique(np.where(ids % 3 == 0, -1, ids % pairs), return_counts=True)
        assert (row["failed"], row["total"]) == ((counts > 1).sum(), 3 * pairs)
        assert row["failed"] > 2**18

    def test_auto_measures_rows(self, spark, monkeypatch):
        text = F.sha2(F.col("id").cast("string"), 512)
        unique = spark.range(20_000).select("id", text.alias("t"))
        repeated = spark.range(20_000).select((F.col("id") % 100).alias("id"), F.repeat(F.lit("x"), 90).alias("t"))
        short = spark.range(20_000).select(F.col("id").cast("string").alias("t"))
        keys = spark.range(20_000)
        taken = []
        for name in ("_direct_counts", "_fingerprint_counts"):
            own = getattr(duplicates, name)
            monkeypatch.setattr(
                duplicates, name, lambda *a, own=own, name=name: taken.append((name, *a[1:])) or own(*a)
            )
        monkeypatch.setattr(duplicates, "SLICE", 4)
        found = [duplicate_groups(f, f.columns).first()["failed"] for f in (unique, repeated, short, keys)]
        assert found == [0, 100, 0, 0]
        assert taken == [("_fingerprint_counts", True), *[("_direct_counts",)] * 3]
        measured = duplicates.measure(repeated.union(unique).toDF("k0", "k1"))
        assert 0.3 < measured.repeats < 0.7 and 90 < measured.width < 145 and measured.repeated > 0

    def test_strategy_is_open_to_rules(self, spark):
        df = spark.createDataFrame([("a",), ("a",)], "x string")
        for strategy in ("direct", "fingerprint", "auto"):
            assert failed(df, "duplicate_row_check", strategy=strategy) == 1
        with pytest.raises(ValueError, match="strategy"):
            run_check(df, "duplicate_row_check", "x", strategy="other")


def test_awkward_column_names(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "`a b` string, `c.d` string")
    assert failed(df, "null_check", "c.d") == 1
    assert failed(df, "data_type_check", "a b", expected_type="date") == 2


def test_struct_field_by_path(spark):
    df = spark.createDataFrame([((None,),), ((1,),)], "s struct<v:int>")
    assert failed(df, "null_check", "s.v") == 1


def test_timestamps_pass_date_rules(spark):
    df = column_of(spark, [datetime(2024, 1, 1, 5), None], "timestamp")
    assert failed(df, "data_type_check", expected_type="TIMESTAMP") == 0
    assert failed(df, "date_validity_check") == 1
