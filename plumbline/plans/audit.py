"""Audit of a target table against its source.

Completeness, reconciliation and timeliness are plain aggregates, so a run takes one
aggregation over the target, one over the source and one grouping for the keys; very many
columns take some more, each over its own columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.names import name_sql, text_literal
from plumbline.functions.sums import Rows, compared, gathered, one_row, sum_parts, width
from plumbline.operators.duplicates import duplicate_groups
from plumbline.results import (
    AUDIT_SCHEMA,
    COMPLETENESS,
    ERROR,
    FAIL,
    PASS,
    RECONCILIATION,
    TIMELINESS,
    UNIQUENESS,
)
from plumbline.sources.audit_log import append_audit

# The timeliness column, the audit time format and the job's defaults.
BUSINESS_DAY = "edi_business_day"
AUDIT_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
DEFAULT_KEYS = ("order_id",)
DEFAULT_NOT_NULL = ("customer_id", "amount")
DEFAULT_VALUE = "amount"
DEFAULT_LAG_DAYS = 2


@dataclass(frozen=True)
class _Stamp:
    """What all records of a run share."""

    business_day: str
    as_of: datetime

    @classmethod
    def of(cls, business_day: str | date, as_of: datetime | date | None) -> _Stamp:
        if as_of is None:
            as_of = datetime.now(UTC)
        elif not isinstance(as_of, datetime):
            as_of = datetime(as_of.year, as_of.month, as_of.day)
        elif as_of.tzinfo is not None:
            as_of = as_of.astimezone(UTC)
        return cls(str(business_day), as_of)


# Comments of the records.
NULLS_COMMENT = "Null values in {}: "
NON_NULL_COUNT_COMMENT = "Non-null count check"
COUNT_COMMENT = "Count check"
SUM_COMMENT = "Sum check"
SOURCE_COMMENT, TARGET_COMMENT = " — Source: ", ", Target: "
KEYS_COMMENT = "Duplicate key rows found: "
LATEST_COMMENT, LAG_COMMENT = "Latest date: ", ", lag days: "


@dataclass(frozen=True)
class _Measure:
    """One value, or one sum in parts, to take from a table; named as ``name``."""

    name: str
    inputs: list[tuple[str, str]] = field(default_factory=list)
    derived: list[tuple[str, str]] = field(default_factory=list)
    rares: list[tuple[str, str]] = field(default_factory=list)
    aggregates: list[tuple[str, str]] = field(default_factory=list)
    outputs: list[str] = field(default_factory=list)
    width: int = 1


@dataclass(frozen=True)
class _Unit:
    """What belongs together: a measure of the target, of the source if any, and SQL for the
    records made of them.

    Records refer to a target value by its name and to a source one as ``source.name``. ``sums``
    names sums of both sides to compare, how they are written, and the tolerance.
    """

    target: _Measure
    records: list[str]
    source: _Measure | None = None
    sums: tuple[str, bool, float] | None = None


def _record(dimension: str, column_name: str, status: str, failed_rows: str, comment: str) -> str:
    """SQL for one audit record, without the fields that a whole run shares."""
    return (
        f"named_struct('dq_dimension', '{dimension}', 'column_name', {text_literal(column_name)}, "
        f"'status', {status}, 'failed_rows', CAST({failed_rows} AS DOUBLE), "
        f"'dq_comment', {comment})"
    )


def _pass_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN '{PASS}' ELSE '{FAIL}' END"


def _records(measured: DataFrame, records: list[str], stamp: _Stamp) -> DataFrame:
    """Unfold the one measured row into audit records. A record without status is none."""
    shared = {
        "audit_timestamp": text_literal(stamp.as_of.strftime(AUDIT_TIME_FORMAT)),
        "edi_business_day": text_literal(stamp.business_day),
    }
    typed = [
        f"CAST({shared.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in AUDIT_SCHEMA
    ]
    unfolded = measured.selectExpr(f"inline(array({', '.join(records)}))")
    return unfolded.where("status IS NOT NULL").selectExpr(*typed)


def _no_records(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], AUDIT_SCHEMA)


# Double columns of one scan. Java compiles methods of up to 8,000 bytes, and taking doubles apart
# needs some 2,300 for each column; beyond that a scan is several times slower.
MOST_DOUBLES = 3


def _scans(units: list[_Unit], fields: int) -> list[list[_Unit]]:
    """Units in as many scans as Spark and Java can compile."""
    scans: list[list[_Unit]] = []
    taken = doubles = 0
    for unit in units:
        sides = [unit.target, *([unit.source] if unit.source else [])]
        own, own_doubles = max(m.width for m in sides), max(len(m.rares) for m in sides)
        taken, doubles = taken + own, doubles + own_doubles
        if not scans or taken > fields or doubles > MOST_DOUBLES:
            scans.append([])
            taken, doubles = own, own_doubles
        scans[-1].append(unit)
    return scans


def _taken(df: DataFrame, measures: list[_Measure]) -> DataFrame:
    """One row with all measures of a side."""
    rows = Rows(
        [x for m in measures for x in m.inputs],
        [x for m in measures for x in m.derived],
        [x for m in measures for x in m.rares],
        [x for m in measures for x in m.aggregates],
    )
    return one_row(df, rows, [x for m in measures for x in m.outputs])


def _beside(target: DataFrame, source: DataFrame) -> DataFrame:
    """Two one-row frames as one row: the target's columns and the struct ``source``."""
    one = target.select(F.struct("*").alias("target"))
    two = source.select(F.struct("*").alias("source"))
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in (one.schema[0], two.schema[0])}
    both = one.withColumn("source", nothing["source"]).unionByName(
        two.withColumn("target", nothing["target"])
    )
    return both.agg(
        F.any_value("target", True).alias("target"), F.any_value("source", True).alias("source")
    ).select("target.*", "source")


def _measure(
    target: DataFrame, source: DataFrame | None, units: list[_Unit], stamp: _Stamp
) -> DataFrame:
    if not units:
        return _no_records(target)
    fields = int(target.sparkSession.conf.get("spark.sql.codegen.maxFields", "100")) - 10
    parts = []
    for scan in _scans(units, fields):
        measured = _taken(target, [u.target for u in scan])
        sources = [u.source for u in scan if u.source]
        if sources:
            measured = _beside(measured, _taken(source, sources))
        for name, plain, tolerance in (u.sums for u in scan if u.sums):
            both = compared(F.col(f"source.{name}"), F.col(name), plain, tolerance)
            measured = measured.withColumn(f"{name}_compared", both)
        parts.append(_records(measured, [r for u in scan for r in u.records], stamp))
    return reduce(DataFrame.unionByName, parts)


def _completeness(target: DataFrame, columns: list[str] | None) -> list[_Unit]:
    units = []
    for i, name in enumerate(columns or []):
        nulls, is_null = f"nulls_{i}", f"null_{i}"
        comment = f"concat({text_literal(NULLS_COMMENT.format(name))}, {nulls})"
        taken = _Measure(
            nulls,
            inputs=[(is_null, f"{name_sql(target, name)} IS NULL")],
            aggregates=[(nulls, f"count_if({is_null})")],
            outputs=[f"coalesce(sum({nulls}), 0) AS {nulls}"],
        )
        record = _record(COMPLETENESS, name, _pass_if(f"{nulls} = 0"), nulls, comment)
        units.append(_Unit(taken, [record]))
    return units


def _value_columns(value_columns: str | list[str] | None) -> list[str]:
    names = [value_columns] if isinstance(value_columns, str) else list(value_columns or [])
    for name in names:
        if not isinstance(name, str):
            raise TypeError(f"value_columns must hold column names, got {type(name).__name__}")
    return [name for name in names if name]


def _count_record(name: str, label: str, count: str) -> str:
    source, target = f"source.{count}", count
    return _record(
        RECONCILIATION,
        name,
        _pass_if(f"{source} = {target}"),
        f"abs({source} - {target})",
        f"concat('{label}{SOURCE_COMMENT}', {source}, '{TARGET_COMMENT}', {target})",
    )


def _sum_record(name: str, total: str) -> str:
    """Equal totals? NaN or infinite values make it an error instead."""
    errors = f"(source.{total}.bad + {total}.bad)"
    both = f"{total}_compared"
    sums = (
        f"concat('{SUM_COMMENT}{SOURCE_COMMENT}', {both}.source, '{TARGET_COMMENT}', {both}.target)"
    )
    broken = f"concat('{SUM_COMMENT} — values without an exact sum: ', {errors})"
    return _record(
        RECONCILIATION,
        name,
        f"CASE WHEN {errors} > 0 THEN '{ERROR}' ELSE {_pass_if(f'{both}.equal')} END",
        f"CASE WHEN {errors} > 0 THEN CAST({errors} AS DOUBLE) ELSE {both}.gap END",
        f"CASE WHEN {errors} > 0 THEN {broken} ELSE {sums} END",
    )


def _reconciliation(
    source: DataFrame,
    target: DataFrame,
    value_columns: str | list[str] | None,
    mode: str,
    tolerance: float,
) -> list[_Unit]:
    if mode not in ("non_null", "rows"):
        raise ValueError(f"mode must be 'non_null' or 'rows', got {mode!r}")
    label = NON_NULL_COUNT_COMMENT if mode == "non_null" else COUNT_COMMENT
    units = []
    for i, name in enumerate(_value_columns(value_columns)):
        counted, total = f"count_{i}", f"sum_{i}"
        sides = []
        for df in (source, target):
            value = name_sql(df, name)
            parts = sum_parts(total, value, df.select(F.col(value)).schema[0].dataType)
            rows = (f"{total}_rows", "count(*)")
            count = f"{total}.n" if mode == "non_null" else f"sum({rows[0]})"
            outputs = [gathered(parts)]
            if mode == "rows":
                outputs.append(f"coalesce({count}, 0) AS {counted}")
            sides.append(
                _Measure(
                    total,
                    inputs=parts.inputs,
                    derived=parts.derived,
                    rares=[(parts.name, parts.rare)] if parts.rare else [],
                    aggregates=parts.aggregates + ([rows] if mode == "rows" else []),
                    outputs=outputs,
                    width=width(parts),
                )
            )
        records = [
            _count_record(name, label, counted if mode == "rows" else f"{total}.n"),
            _sum_record(name, total),
        ]
        units.append(_Unit(sides[1], records, sides[0], (total, mode == "rows", tolerance)))
    return units


def _timeliness(target: DataFrame, stamp: _Stamp, expected_lag_days: int) -> list[_Unit]:
    if BUSINESS_DAY not in target.columns:
        return []
    lag = f"datediff(DATE'{stamp.as_of.date()}', latest)"
    on_time = _pass_if(f"{lag} <= {int(expected_lag_days)}")
    latest = _Measure(
        "latest",
        inputs=[("business_day", f"CAST({name_sql(target, BUSINESS_DAY)} AS DATE)")],
        aggregates=[("latest_day", "max(business_day)")],
        outputs=["max(latest_day) AS latest"],
    )
    record = _record(
        TIMELINESS,
        BUSINESS_DAY,
        f"CASE WHEN latest IS NOT NULL THEN {on_time} END",
        lag,
        f"concat('{LATEST_COMMENT}', latest, '{LAG_COMMENT}', {lag})",
    )
    return [_Unit(latest, [record])]


def check_uniqueness(
    df: DataFrame,
    primary_key_columns: list[str] | None,
    edi_business_day: str | date,
    *,
    as_of: datetime | date | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Number of key values held by more than one row; no record without key columns.

    ``strategy`` is that of ``duplicate_groups``.
    """
    keys = list(primary_key_columns or [])
    if not keys:
        return _no_records(df)
    comment = f"concat('{KEYS_COMMENT}', failed)"
    record = _record(UNIQUENESS, ",".join(keys), _pass_if("failed = 0"), "failed", comment)
    stamp = _Stamp.of(edi_business_day, as_of)
    return _records(duplicate_groups(df, keys, strategy), [record], stamp)


def check_completeness(
    df: DataFrame,
    not_null_columns: list[str] | None,
    edi_business_day: str | date,
    *,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Null count per column, all columns in one scan."""
    stamp = _Stamp.of(edi_business_day, as_of)
    return _measure(df, None, _completeness(df, not_null_columns), stamp)


def check_reconciliation(
    df_source: DataFrame,
    df_target: DataFrame,
    value_columns: str | list[str] | None,
    edi_business_day: str | date,
    *,
    mode: str = "non_null",
    tolerance: float = 0,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Count and sum per column, equal on both sides? One scan per side for all columns.

    ``mode`` compares non-null values (``non_null``) or all rows (``rows``). Sums are exact and
    do not depend on partitioning, also where the sides have unlike types; NaN and infinity have
    no exact sum and give an ERROR record.
    """
    stamp = _Stamp.of(edi_business_day, as_of)
    units = _reconciliation(df_source, df_target, value_columns, mode, tolerance)
    return _measure(df_target, df_source, units, stamp)


def check_timeliness(
    df: DataFrame,
    edi_business_day: str | date,
    expected_lag_days: int = DEFAULT_LAG_DAYS,
    *,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Age in days of the latest ``edi_business_day``; no record without such a date."""
    stamp = _Stamp.of(edi_business_day, as_of)
    return _measure(df, None, _timeliness(df, stamp, expected_lag_days), stamp)


def run_dq_checks(
    df_source: DataFrame,
    df_target: DataFrame,
    edi_business_day: str | date,
    primary_key_columns: list[str] | None = None,
    not_null_columns: list[str] | None = None,
    value_column: str | list[str] | None = None,
    expected_lag_days: int = DEFAULT_LAG_DAYS,
    *,
    mode: str = "non_null",
    tolerance: float = 0,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """All audit records of a run, lazily: uniqueness, completeness, reconciliation, timeliness."""
    stamp = _Stamp.of(edi_business_day, as_of)
    units = (
        _completeness(df_target, not_null_columns)
        + _reconciliation(df_source, df_target, value_column, mode, tolerance)
        + _timeliness(df_target, stamp, expected_lag_days)
    )
    parts = []
    if primary_key_columns:
        parts.append(
            check_uniqueness(
                df_target, primary_key_columns, stamp.business_day, as_of=stamp.as_of
            )
        )
    if units or not parts:
        parts.append(_measure(df_target, df_source, units, stamp))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


@dataclass(frozen=True)
class AuditParams:
    """Parameters of an audit job, with its defaults."""

    edi_business_day: str
    dq_audit_path: str
    primary_key_columns: list[str] = field(default_factory=lambda: list(DEFAULT_KEYS))
    not_null_columns: list[str] = field(default_factory=lambda: list(DEFAULT_NOT_NULL))
    value_column: str | list[str] = DEFAULT_VALUE
    expected_lag_days: int = DEFAULT_LAG_DAYS

    @classmethod
    def of(cls, parameters: Mapping[str, Any]) -> AuditParams:
        """From a mapping; the business day and the audit path must be there."""
        known = {k: parameters[k] for k in cls.__dataclass_fields__ if k in parameters}
        lacking = [k for k in ("edi_business_day", "dq_audit_path") if k not in known]
        if lacking:
            raise KeyError(f"audit parameters lack {', '.join(lacking)}")
        known["expected_lag_days"] = int(known.get("expected_lag_days", DEFAULT_LAG_DAYS))
        return cls(**known)


def run_audit_job(
    df_source: DataFrame,
    df_target: DataFrame,
    parameters: Mapping[str, Any] | AuditParams,
    *,
    mode: str = "non_null",
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Audit, append the records to the audit path and return them."""
    params = parameters if isinstance(parameters, AuditParams) else AuditParams.of(parameters)
    records = run_dq_checks(
        df_source,
        df_target,
        params.edi_business_day,
        params.primary_key_columns,
        params.not_null_columns,
        params.value_column,
        params.expected_lag_days,
        mode=mode,
        as_of=as_of,
    )
    return append_audit(records, params.dq_audit_path)
