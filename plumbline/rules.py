"""What a check is made of, and the register of checks by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from plumbline.functions.names import column_named

TableResolver = Callable[[str], DataFrame]


@dataclass(frozen=True)
class RuleContext:
    """The table under check, and a way to reach other tables by name."""

    df: DataFrame
    tables: TableResolver

    def column(self, name: str) -> Column:
        return column_named(self.df, name)

    def data_type(self, name: str) -> T.DataType:
        if name in self.df.columns:
            return self.df.schema[name].dataType
        return self.df.select(self.column(name)).schema[0].dataType

    @cached_property
    def spark(self):
        return self.df.sparkSession


@dataclass(frozen=True)
class RowRule:
    """A check decided row by row. All row rules of a table share one aggregation.

    ``failed`` marks a failing row: only TRUE counts, so an unknown result passes.
    ``scope`` restricts the rows that make up the total.
    """

    failed: Column
    scope: Column | None = None
    zero_when_empty: bool = False


@dataclass(frozen=True)
class SetRule:
    """A check that needs its own grouping: one row with ``failed`` and ``total``."""

    counts: DataFrame
    zero_when_empty: bool = False


@dataclass(frozen=True)
class ReferenceRule:
    """Every value must be one of the keys. All references of a table share one grouping."""

    value: Column
    keys: DataFrame
    key: Column
    zero_when_empty: bool = False


Rule = RowRule | SetRule | ReferenceRule
Builder = Callable[..., "Column | DataFrame | Rule"]

# Check name -> builder(context, column, **params).
DQ_FUNCTIONS: dict[str, Builder] = {}


def dq_check(name: str) -> Callable[[Builder], Builder]:
    """Register a check builder under ``name``; a later registration replaces an earlier one.

    The builder gets ``(context, column, **params)`` and returns a boolean column that marks
    failing rows, a one-row frame with ``failed`` and ``total``, or a rule object.
    """

    def register(builder: Builder) -> Builder:
        DQ_FUNCTIONS[name] = builder
        return builder

    return register


def build_rule(
    dq_type: str, context: RuleContext, column: str | None, params: dict
) -> Rule:
    """Run the registered builder and normalise what it returns."""
    built = DQ_FUNCTIONS[dq_type](context, column, **params)
    if isinstance(built, DataFrame):
        return SetRule(built)
    if isinstance(built, Column):
        return RowRule(built)
    if isinstance(built, Rule):
        return built
    raise TypeError(f"check {dq_type} returned {type(built).__name__}")
