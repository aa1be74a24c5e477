from __future__ import annotations

import math
import random
from decimal import Context, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from plumbline.functions import (
    exact_sums,
    first_table_name,
    spark_date_pattern,
    text_literal,
)


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("YYYY-MM-DD", "yyyy-MM-dd"),
        ("DD/MM/YY", "dd/MM/yy"),
        ("DD-MON-YYYY", "dd-MMM-yyyy"),
        ("YYYY-MM-DD HH24:MI:SS", "yyyy-MM-dd HH:mm:ss"),
        ("YYYY-MM-DDTHH24:MI:SS.FF3", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        ('YYYY-MM-DD"T"HH12:MI AM', "yyyy-MM-dd'T'hh:mm a"),
        ("yyyy-MM-dd", "yyyy-MM-dd"),
        ("dd.MM.yyyy HH:mm:ss.SSS", "dd.MM.yyyy HH:mm:ss.SSS"),
        ("yyyy-mm-dd", "yyyy-MM-dd"),
        ("Yyyy-Mm-Dd", "yyyy-MM-dd"),
        ("DD-Mon-YYYY", "dd-MMM-yyyy"),
        ("mm/dd/yy", "MM/dd/yy"),
        ("yyyy-mm-dd hh24:mi:ss.ff3", "yyyy-MM-dd HH:mm:ss.SSS"),
        ("dd MMM yyyy", "dd MMM yyyy"),
    ],
)
def test_date_formats(given, expected):
    assert spark_date_pattern(given) == expected


@pytest.mark.parametrize(
    ("query", "table"),
    [
        ("select * from a.b.c where x in (select y from z)", "a.b.c"),
        ("SELECT 1 FROM\n\tt1 JOIN t2", "t1"),
        ("update x set y = 1", None),
        ("", None),
        (None, None),
    ],
)
def test_first_table(spark, query, table):
    df = spark.createDataFrame([(query,)], "q string")
    assert df.select(first_table_name(F.col("q"))).first()[0] == table


def summed(spark, values, data_type):
    df = spark.createDataFrame([(v,) for v in values], f"x {data_type}")
    return exact_sums(df, ["x"]).first()["x"]


@pytest.mark.parametrize(
    ("values", "data_type", "text"),
    [
        ([0.1] * 10, "double", "1.0"),
        ([1234567.25, 0.0, None], "double", "1234567.25"),
        ([100.0], "double", "100.0"),
        ([2**62, 2**62, 2**62], "long", str(3 * 2**62)),
        ([1, -1], "int", "0.0"),
        ([Decimal("1.50"), Decimal("2.00")], "decimal(10,2)", "3.50"),
        ([None], "double", "0.0"),
        ([], "double", "0.0"),
        ([1e27, 1.0, -1e-13], "double", "1000000000000000000000000000.9999999999999"),
        ([1e-13] * 1000, "double", "0.0000000001"),
        ([1e308] * 3, "double", "3" + "0" * 308 + ".0"),
        ([5e-324, -1.5], "double", None),
        ([Decimal("12345678." + "0" * 29 + "1")] * 3, "decimal(38,30)", "37037034." + "0" * 29 + "3"),
        ([Decimal("9" * 38), Decimal(1)], "decimal(38,0)", "1" + "0" * 38),
        ([Decimal("-9" + "9" * 37), Decimal("-9" + "9" * 37)], "decimal(38,0)", "-1" + "9" * 37 + "8"),
    ],
)
def test_exact_sums(spark, values, data_type, text):
    found = summed(spark, values, data_type)
    if text is None:  # too long to write down
        text = f"{exact(spark, values):f}"
    assert found == text


def exact(spark, values):
    """The sum of the decimals that Spark shows the values as."""
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    with localcontext(Context(prec=1200)):
        texts = (r.t for r in frame.selectExpr("CAST(x AS STRING) AS t").collect())
        return +sum((Decimal(t) for t in texts), Decimal(0))


@pytest.mark.parametrize("text", ["it's", "a\\b", "\\'", "é — \n", ""])
def test_text_literal(spark, text):
    assert spark.range(1).selectExpr(f"{text_literal(text)} AS t").first()["t"] == text


def random_doubles(seed):
    pick = random.Random(seed)
    values = [0.0, -0.0, 0.000001, -0.000001, 999999999.999999, -999999999.999999, 1e9, -1e9]
    for _ in range(400):
        places, size = pick.randrange(9), pick.randrange(1, 10)
        values.append(round(pick.uniform(-(10**size), 10**size), places))
        values.append(pick.uniform(-1, 1) * 10.0 ** pick.randrange(-300, 300))
    return values


@pytest.mark.parametrize("seed", range(3))
def test_sum_of_doubles_is_the_sum_of_their_texts(spark, seed):
    values = random_doubles(seed)
    assert Decimal(summed(spark, values, "double")) == exact(spark, values)


def test_sum_of_doubles_at_the_edges_of_the_ranges(spark):
    edges = [1e-4, 1e-3, 1e7, 1e9, 1e15, 1e17, 2.0**53, 1e10, 1.0]
    values = [0.1 + 0.2, 9.999999999999998, 999.9999999999999, 4.35, 1234567.1234567, 1e22, 1.1e-5]
    for e in edges:
        values += [e, math.nextafter(e, 0), math.nextafter(e, math.inf), e * 1.1, e * 1.0000001, e / 3]
    values += [-v for v in values[::2]]
    assert Decimal(summed(spark, values, "double")) == exact(spark, values)


def test_sums_of_rare_values_stand_apart(spark):
    """Tiny and huge values of several columns, in the same rows and in others."""
    pick = random.Random(8)
    rows = [
        tuple(pick.choice((0.25, pick.uniform(1, 2))) * 10.0 ** pick.randrange(-30, 30) for _ in range(3))
        for _ in range(300)
    ]
    frame = spark.createDataFrame(rows, "x double, y double, z double")
    for n in (1, 3, 7):
        row = exact_sums(frame.repartition(n), ["x", "y", "z"]).first()
        for i, name in enumerate("xyz"):
            assert Decimal(row[name]) == exact(spark, [r[i] for r in rows])


def test_sum_of_any_doubles_keeps_under_partitioning(spark):
    pick = random.Random(5)
    values = [pick.uniform(-1, 1) * 10 ** pick.randrange(-8, 12) for _ in range(5000)]
    frame = spark.createDataFrame([(v, v) for v in values], "x double, y double")
    totals = {exact_sums(frame.repartition(n), ["x", "y"]).first() for n in (1, 3, 7)}
    assert len(totals) == 1
    assert Decimal(totals.pop()["x"]) == exact(spark, values)
