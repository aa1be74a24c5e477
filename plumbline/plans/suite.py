"""Running a configuration of rules with as few scans as possible.

The row rules of a table become one aggregation over one column-pruned scan, or a few when they
are very many, and its references one grouping over another. Rules that need a grouping of their
own are added with a union, so that Spark runs their stages side by side.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    ParseException,
    PySparkException,
    PythonException,
)
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import operators  # noqa: F401  (registers the built-in checks)
from plumbline.config import RuleSpec, read_config
from plumbline.operators.references import count_missing
from plumbline.results import (
    ERROR,
    GRADED_ERROR_SQL,
    GRADED_FAILED_SQL,
    PERCENT_SQL,
    RULE_RESULT_SCHEMA,
    STATUS_SQL,
)
from plumbline.rules import (
    DQ_FUNCTIONS,
    ReferenceRule,
    RowRule,
    Rule,
    RuleContext,
    SetRule,
    TableResolver,
    build_rule,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class _Ready:
    """A rule that passed analysis, at its place in the configuration."""

    place: int
    spec: RuleSpec
    df: DataFrame
    rule: Rule


def _java_causes(error: Exception) -> list[Any]:
    """The Java exceptions behind an error, the deepest last; none if Python raised it."""
    if isinstance(error, Py4JJavaError):
        cause = error.java_exception
    else:
        cause = getattr(error, "_origin", None)
    causes: list[Any] = []
    while cause is not None and not any(cause.equals(seen) for seen in causes):
        causes.append(cause)
        cause = cause.getCause()
    return causes


def _message(error: Exception) -> str:
    """What went wrong; of a chain of Java exceptions, what the deepest one says."""
    if isinstance(error, Py4JJavaError):
        deepest = _java_causes(error)[-1]
        return str(deepest.getMessage() or deepest.toString()).strip()
    return str(error).split("\n\nJVM stacktrace:")[0].strip()


def _error_row(spec: RuleSpec, error: Exception) -> Row:
    return Row(
        table=spec.table,
        column=spec.column,
        dq_type=spec.dq_type,
        status=ERROR,
        failed=None,
        percent=None,
        error=_message(error),
    )


# Errors that the data or a rule cause: data exceptions, functions of the user, unresolved names,
# errors raised in SQL. Others, say a cancelled job or a lost cluster, are nobody's rule.
_RULE_SQLSTATES = ("21", "22", "38", "39", "42", "P0")
_RULE_ERRORS = (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    ParseException,
    PythonException,
)


# Exceptions of Java's library that values or patterns cause in a task, and the type
# of Spark's own exceptions.
_JAVA_RULE_ERRORS = (
    "java.lang.ArithmeticException",
    "java.lang.ArrayIndexOutOfBoundsException",
    "java.lang.NumberFormatException",
    "java.time.DateTimeException",
    "java.util.regex.PatternSyntaxException",
)
_SPARK_THROWABLE = "org.apache.spark.SparkThrowable"


def _is_rule_cause(cause: Any) -> bool:
    gateway = SparkContext._gateway
    if is_instance_of(gateway, cause, _SPARK_THROWABLE):
        state = cause.getSqlState()
        if state:
            return state.startswith(_RULE_SQLSTATES)
    return any(is_instance_of(gateway, cause, name) for name in _JAVA_RULE_ERRORS)


def _is_rule_error(error: Exception) -> bool:
    """Judged by the whole chain of causes: the failure of a subquery, say, arrives wrapped in
    exceptions of the jobs and threads that it passed through."""
    if isinstance(error, PySparkException):
        state = error.getSqlState()
        if state.startswith(_RULE_SQLSTATES) if state else isinstance(error, _RULE_ERRORS):
            return True
    return any(_is_rule_cause(cause) for cause in _java_causes(error))


def _is_job_failure(error: Exception) -> bool:
    """Did a job fail that a check ran while it was built, and for no rule's fault?"""
    return not _is_rule_error(error) and any(
        is_instance_of(SparkContext._gateway, cause, "org.apache.spark.SparkException")
        for cause in _java_causes(error)
    )


def _most_aggregates(df: DataFrame) -> int:
    """Spark compiles a stage as a whole up to a number of fields. A wider aggregation is
    interpreted, several times slower, so more rules than this take another scan."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.codegen.maxFields", "100")) - 10)


def _scan_groups(rules: list[_Ready]) -> list[list[_Ready]]:
    """Row rules of one table, split into as many scans as they need.

    Rules of the same column stay together: with column pruning each scan reads its own
    columns, and together they read little more than one scan of all columns would.
    """
    by_column = sorted(rules, key=lambda r: str(r.spec.column))
    sizes = [1 if r.rule.scope is None else 2 for r in by_column]
    scans = -(-sum(sizes) // _most_aggregates(rules[0].df))
    share = sum(sizes) / max(scans, 1)
    groups: list[list[_Ready]] = [[] for _ in range(scans)]
    before = 0
    for ready, size in zip(by_column, sizes, strict=True):
        groups[min(int(before / share), scans - 1)].append(ready)
        before += size
    return groups


def _count_row_rules(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """One row: ``total``, ``failed_i`` per rule and ``total_i`` where it has a scope."""
    aggregates = [F.count("*").alias("total")]
    for i, rule in enumerate(rules):
        aggregates.append(F.count(F.when(rule.failed, 1)).alias(f"failed_{i}"))
        if rule.scope is not None:
            aggregates.append(F.count(F.when(rule.scope, 1)).alias(f"total_{i}"))
    return df.agg(*aggregates)


def _rule_sql(ready: _Ready, failed: str, total: str) -> str:
    """SQL for the counts of one rule, marked with its place in the configuration."""
    return (
        f"named_struct('place', {ready.place}, 'failed', CAST({failed} AS BIGINT), "
        f"'total', CAST({total} AS BIGINT), 'zero_when_empty', {ready.rule.zero_when_empty})"
    )


def _row_rule_counts(df: DataFrame, ready: list[_Ready]) -> DataFrame:
    structs = [
        _rule_sql(r, f"failed_{i}", "total" if r.rule.scope is None else f"total_{i}")
        for i, r in enumerate(ready)
    ]
    counts = _count_row_rules(df, [r.rule for r in ready])
    return counts.selectExpr(f"inline(array({', '.join(structs)}))")


def _set_rule_counts(ready: _Ready) -> DataFrame:
    return ready.rule.counts.selectExpr(f"inline(array({_rule_sql(ready, 'failed', 'total')}))")


def _reference_counts(df: DataFrame, ready: list[_Ready]) -> DataFrame:
    places = F.array(*[F.lit(r.place) for r in ready])
    return count_missing(df, [r.rule for r in ready]).select(
        places[F.col("rule")].alias("place"),
        F.col("failed").cast("long"),
        F.col("total").cast("long"),
        F.lit(False).alias("zero_when_empty"),
    )


def _by_table(ready: list[_Ready], kind: type) -> list[list[_Ready]]:
    tables: dict[int, list[_Ready]] = {}
    for r in ready:
        if isinstance(r.rule, kind):
            tables.setdefault(id(r.df), []).append(r)
    return list(tables.values())


def _rule_counts(ready: list[_Ready]) -> list[DataFrame]:
    """``place, failed, total, zero_when_empty``: one frame per scan of row rules, one for the
    references of a table, one per set rule."""
    row_rules = [
        _row_rule_counts(group[0].df, group)
        for rules in _by_table(ready, RowRule)
        for group in _scan_groups(rules)
    ]
    references = [
        _reference_counts(rules[0].df, rules) for rules in _by_table(ready, ReferenceRule)
    ]
    sets = [_set_rule_counts(r) for r in ready if isinstance(r.rule, SetRule)]
    return row_rules + references + sets


# Jobs that the driver submits at a time.
MOST_JOBS = 16

_LABELS = "array<struct<table: string, column: string, dq_type: string, threshold: double>>"


def _threshold(spec: RuleSpec) -> float | None:
    try:
        return float(spec.threshold)
    except (TypeError, ValueError):
        return None


def _analysed(ready: list[_Ready]) -> list[DataFrame]:
    """The counting frames; raises if Spark cannot resolve a rule. Runs no job."""
    counts = _rule_counts(ready)
    for frame in counts:
        frame.schema  # noqa: B018
    return counts


class _Suite:
    """Rules ready to run, and the rows of those that failed before running."""

    def __init__(self, spark: SparkSession, config: Mapping[str, Any], tables: TableResolver):
        self.spark = spark
        self.tables = tables
        self.specs = read_config(config)
        self.parts: list[tuple[list[_Ready], list[DataFrame]]] = []
        self.errors: dict[int, Row] = {}
        by_table: dict[str, list[int]] = {}
        for place, spec in enumerate(self.specs):
            if spec.dq_type in DQ_FUNCTIONS:
                by_table.setdefault(spec.table, []).append(place)
            else:
                log.warning("unknown check %s on %s skipped", spec.dq_type, spec.table)
        for table, places in by_table.items():
            self._add_table(table, places)

    def _fail(self, place: int, error: Exception) -> None:
        self.errors[place] = _error_row(self.specs[place], error)

    def _add_table(self, table: str, places: list[int]) -> None:
        try:
            context = RuleContext(self.tables(table), self.tables)
            context.df.schema  # noqa: B018
        except Exception as error:
            for place in places:
                self._fail(place, error)
            return
        built = []
        for place in places:
            spec = self.specs[place]
            try:
                float(spec.threshold)
                rule = build_rule(spec.dq_type, context, spec.column, dict(spec.params))
                built.append(_Ready(place, spec, context.df, rule))
            except Exception as error:
                if _is_job_failure(error):
                    raise
                self._fail(place, error)
        try:
            counts = _analysed(built)
        except Exception:
            built = [r for r in built if self._resolves(r)]
            counts = _analysed(built)
        if built:
            self.parts.append((built, counts))

    def _resolves(self, ready: _Ready) -> bool:
        try:
            _analysed([ready])
            return True
        except Exception as error:
            self._fail(ready.place, error)
            return False

    def _graded(self, counts: list[DataFrame]) -> DataFrame:
        """Counted rules with their labels and grades. The labels are one folded literal."""
        labels = [
            {"table": s.table, "column": s.column, "dq_type": s.dq_type, "threshold": t}
            for s in self.specs
            for t in [_threshold(s)]
        ]
        literal = F.from_json(F.lit(json.dumps(labels, default=str)), _LABELS)
        return (
            reduce(DataFrame.unionByName, counts)
            .withColumn("label", literal[F.col("place")])
            .selectExpr("place", "failed", "label.*", f"{PERCENT_SQL} AS percent")
            .selectExpr(
                "place",
                "table",
                "column",
                "dq_type",
                f"{STATUS_SQL} AS status",
                f"{GRADED_FAILED_SQL} AS failed",
                "percent",
                f"{GRADED_ERROR_SQL} AS error",
            )
        )

    def frame(self) -> DataFrame:
        """Lazy results in configured order; a rule that fails at run time fails them all."""
        names = RULE_RESULT_SCHEMA.names
        parts = []
        if self.parts:
            counts = [frame for _, frames in self.parts for frame in frames]
            parts.append(self._graded(counts).select("place", *names))
        if self.errors or not parts:
            rows = [(place, *self.errors[place]) for place in sorted(self.errors)]
            shape = T.StructType([T.StructField("place", T.IntegerType()), *RULE_RESULT_SCHEMA])
            parts.append(self.spark.createDataFrame(rows, shape))
        return reduce(DataFrame.unionByName, parts).orderBy("place").select(*names)

    def _table_rows(self, ready: list[_Ready], counts: list[DataFrame]) -> dict[int, Row]:
        """Results of one table. If its job fails, its rules are halved until those that fail
        stand alone; what has succeeded is kept."""
        done: dict[int, Row] = {}
        parts = [(ready, counts)]
        while parts:
            part, counts = parts.pop()
            try:
                collected = self._graded(counts).collect()
            except Exception as error:
                if not _is_rule_error(error):
                    raise
                if len(part) == 1:
                    done[part[0].place] = _error_row(part[0].spec, error)
                else:
                    middle = len(part) // 2
                    halves = part[middle:], part[:middle]
                    parts += [(half, _rule_counts(half)) for half in halves]
                continue
            done.update((row["place"], row) for row in collected)
        return done

    def rows(self) -> list[Row]:
        """Results in configured order, a rule that fails at run time as an ERROR row.

        The tables' jobs are submitted side by side.
        """
        done = dict(self.errors)
        with ThreadPoolExecutor(max(1, min(len(self.parts), MOST_JOBS))) as pool:
            for rows in pool.map(lambda part: self._table_rows(*part), self.parts):
                done.update(rows)
        names = RULE_RESULT_SCHEMA.names
        return [Row(**{n: done[place][n] for n in names}) for place in sorted(done)]


def plan_dq_from_config(
    spark: SparkSession, config: Mapping[str, Any], tables: TableResolver | None = None
) -> DataFrame:
    """All rules of ``config`` as one lazy frame.

    A rule that Spark cannot resolve is an ERROR row. One that fails on the data, say a text
    that is no number, fails the frame; ``run_dq_from_config`` isolates those too. Duplicate checks
    of rows that may be wide measure them first, unless the rule names a ``strategy``.
    """
    return _Suite(spark, config, tables or spark.table).frame()


def run_dq_from_config(
    spark: SparkSession, config: Mapping[str, Any], tables: TableResolver | None = None
) -> DataFrame:
    """Run all rules of ``config`` and return one row per rule, in configured order.

    One job for each table. If a rule fails on the data, the rules of its table are halved until
    it stands alone, so one bad rule among n costs about log2(n) further scans of that table. Any
    other failure of a job, say that it was cancelled, is raised.
    """
    rows = _Suite(spark, config, tables or spark.table).rows()
    return spark.createDataFrame(rows, RULE_RESULT_SCHEMA)


def run_check(
    df: DataFrame,
    dq_type: str,
    column: str | None = None,
    tables: TableResolver | None = None,
    **params: Any,
) -> DataFrame:
    """One check on one frame: a lazy row with ``failed`` and ``percent``."""
    if dq_type not in DQ_FUNCTIONS:
        raise LookupError(f"unknown check: {dq_type}")
    context = RuleContext(df, tables or df.sparkSession.table)
    ready = _Ready(
        0, RuleSpec("", column, dq_type), df, build_rule(dq_type, context, column, params)
    )
    (counts,) = _rule_counts([ready])
    return counts.selectExpr("failed", f"{PERCENT_SQL} AS percent")
