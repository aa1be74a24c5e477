"""Table resolvers: functions from a table name to a frame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from plumbline.rules import TableResolver


def catalog_tables(spark: SparkSession) -> TableResolver:
    """Tables and views of the session catalog."""
    return spark.table


def parquet_tables(spark: SparkSession, directory: str) -> TableResolver:
    """``name`` is the Parquet file or folder ``directory/name.parquet``.

    A table is listed once: a resolver is meant for one run and shows the files of that time.
    """
    return cache(lambda name: spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet"))


def frames(named: Mapping[str, DataFrame], otherwise: TableResolver | None = None) -> TableResolver:
    """Frames given by name, with another resolver for the rest."""

    def resolve(name: str) -> DataFrame:
        if name in named:
            return named[name]
        if otherwise is None:
            raise LookupError(f"unknown table: {name}")
        return otherwise(name)

    return resolve
