"""Queries over the test tables, one or more per check, each with its SQL counterpart."""

from catalogue import audits, logs, rules, suites
from catalogue.base import Query

ALL: dict[str, Query] = {**rules.QUERIES, **suites.QUERIES, **audits.QUERIES, **logs.QUERIES}

__all__ = ["ALL", "Query"]
