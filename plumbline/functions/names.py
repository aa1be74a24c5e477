"""Turning configured column names into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_sql(df: DataFrame, name: str) -> str:
    """SQL for the column ``name`` of ``df``, whatever characters it holds.

    A dotted name that is no column is a path into a struct.
    """
    if not isinstance(name, str):
        raise TypeError(f"column name must be a string, got {type(name).__name__}")
    if "." in name and name not in df.columns:
        return name
    return "`" + name.replace("`", "``") + "`"


def column_named(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df``; see ``name_sql``."""
    return F.col(name_sql(df, name))


def text_literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
