"""Groups of equal rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.names import column_named
from plumbline.rules import RuleContext, SetRule, dq_check

# Rows of at least so many bytes are worth telling apart by fingerprint, unless more than this share
# of them repeat. Rows that cannot be as long are grouped directly without being measured.
WIDE_ROW_BYTES = 64
MOST_REPEATS = 0.5
# One in so many fingerprints is counted to measure repeats; all copies of a row are in or out.
SLICE = 1024
# Repeated fingerprints, as estimated, that are sent to all tasks: 16 bytes or so each.
MOST_SENT = 1 << 20


def _can_fingerprint(data_type: T.DataType) -> bool:
    """Types whose equal values always hash alike."""
    if isinstance(data_type, T.StringType):
        return data_type == T.StringType()  # other collations call unlike texts equal
    if isinstance(data_type, T.ArrayType):
        return _can_fingerprint(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_can_fingerprint(f.dataType) for f in data_type)
    return isinstance(
        data_type,
        (
            T.NumericType,
            T.BooleanType,
            T.DateType,
            T.TimestampType,
            T.TimestampNTZType,
            T.BinaryType,
        ),
    )


def _equal_rows(rows: DataFrame) -> DataFrame:
    # The alias cannot meet a data column of the name "count".
    return rows.groupBy(*rows.columns).agg(F.expr("count(*) AS __rows"))


def _direct_counts(rows: DataFrame) -> DataFrame:
    return _equal_rows(rows).agg(
        F.expr("count_if(__rows > 1) AS failed"), F.expr("coalesce(sum(__rows), 0) AS total")
    )


def _fingerprint_counts(rows: DataFrame, few: bool = False) -> DataFrame:
    """Shuffle 8-byte fingerprints; only rows whose fingerprint repeats travel whole.

    Equal rows have equal fingerprints, so every duplicate is among those rows, and grouping
    them by all their columns sorts out chance collisions: the count is exact. If the repeated
    fingerprints are known to be ``few``, they are sent to the tasks; otherwise rows meet them in a
    join that adaptive execution plans by size, splitting the partitions of frequent ones. Both
    groupings combine on the map side, so a group that holds a third of all rows is no burden to
    one task.
    """
    values = rows.columns
    printed = rows.withColumn("__print", F.xxhash64(*values))
    per_print = printed.groupBy("__print").agg(F.expr("count(*) AS __rows"))
    repeated = per_print.where("__rows > 1").select("__print")
    if few:
        repeated = F.broadcast(repeated)
    suspects = printed.join(repeated, "__print", "left_semi").select(*values)
    failed = _equal_rows(suspects).agg(F.expr("count_if(__rows > 1) AS failed"))
    total = per_print.agg(F.expr("coalesce(sum(__rows), 0)")).scalar()
    return failed.withColumn("total", total)


def _most_bytes(data_type: T.DataType) -> float:
    """The bytes of a value of the type at most."""
    if isinstance(data_type, T.StructType):
        return 8 + sum(_most_bytes(f.dataType) for f in data_type)
    if isinstance(data_type, T.DecimalType):
        return 16 if data_type.precision > 18 else 8
    if isinstance(data_type, (T.NumericType, T.BooleanType, T.DatetimeType)):
        return 8
    return float("inf")


def _bytes(value: Column, data_type: T.DataType) -> Column:
    """About the bytes of a value."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if _most_bytes(data_type) < float("inf"):
        return F.lit(int(_most_bytes(data_type)))
    return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))


@dataclass(frozen=True)
class Measured:
    """What a sample says of the rows: their mean bytes, the share of them that repeat, and about how
    many different rows do."""

    width: float
    repeats: float
    repeated: int


def measure(rows: DataFrame) -> Measured:
    """Reads the table once and counts a slice of its fingerprints, with all copies of their rows."""
    width = sum(_bytes(F.col(f.name), f.dataType) for f in rows.schema)
    part = rows.select(F.xxhash64(*rows.columns).alias("print"), width.cast("long").alias("width"))
    prints = part.where(F.pmod("print", F.lit(SLICE)) == 0).groupBy("print").agg(
        F.expr("count(*) AS n"), F.expr("sum(width) AS width")
    )
    row = prints.agg(
        F.expr("coalesce(sum(n), 0) AS n"),
        F.expr("coalesce(sum(width), 0) AS width"),
        F.expr("coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS copies"),
        F.expr("count_if(n > 1) AS repeated"),
    ).first()
    n = max(row["n"], 1)
    return Measured(row["width"] / n, row["copies"] / n, row["repeated"] * SLICE)


def _auto_counts(rows: DataFrame) -> DataFrame:
    types = [f.dataType for f in rows.schema]
    narrow = sum(map(_most_bytes, types)) < WIDE_ROW_BYTES
    if narrow or not all(map(_can_fingerprint, types)):
        return _direct_counts(rows)
    found = measure(rows)
    if found.width < WIDE_ROW_BYTES or found.repeats > MOST_REPEATS:
        return _direct_counts(rows)
    return _fingerprint_counts(rows, found.repeated <= MOST_SENT)


def duplicate_groups(df: DataFrame, columns: list[str], strategy: str = "auto") -> DataFrame:
    """One row: ``failed``, the groups of two or more rows equal in ``columns``, and ``total``.

    ``strategy`` decides how, not what: ``direct`` groups by the columns in one scan and is best
    for keys, short columns and rows that mostly repeat; ``fingerprint`` takes two scans and much
    less shuffle for wide rows that mostly differ; ``auto`` measures the rows first, in a job of its
    own that reads the columns once, unless their types tell that they are short. Nulls are equal
    to each other.
    """
    rows = df.select(*[column_named(df, c).alias(f"k{i}") for i, c in enumerate(columns)])
    counts = {
        "auto": _auto_counts, "direct": _direct_counts, "fingerprint": _fingerprint_counts
    }
    if strategy not in counts:
        raise ValueError(f"strategy must be 'auto', 'direct' or 'fingerprint', got {strategy!r}")
    return counts[strategy](rows)


@dq_check("duplicate_row_check")
def duplicate_row_check(
    ctx: RuleContext, column: str | None, strategy: str = "auto"
) -> SetRule:
    """Groups of rows that are equal in all columns. Groups count, not rows."""
    return SetRule(duplicate_groups(ctx.df, ctx.df.columns, strategy))
