"""Data-quality checks on Spark tables: declarative rules, source-to-target audits, query logs."""

from plumbline.config import ConfigError, RuleSpec, read_config
from plumbline.plans.audit import (
    AuditParams,
    check_completeness,
    check_reconciliation,
    check_timeliness,
    check_uniqueness,
    run_audit_job,
    run_dq_checks,
)
from plumbline.plans.suite import plan_dq_from_config, run_check, run_dq_from_config
from plumbline.results import AUDIT_SCHEMA, RULE_RESULT_SCHEMA
from plumbline.rules import (
    DQ_FUNCTIONS,
    RowRule,
    RuleContext,
    SetRule,
    TableResolver,
    dq_check,
)
from plumbline.sources.audit_log import append_audit, write_dq_results
from plumbline.sources.query_log import query_history, query_log_window
from plumbline.sources.tables import catalog_tables, frames, parquet_tables

__all__ = [
    "AUDIT_SCHEMA",
    "AuditParams",
    "ConfigError",
    "DQ_FUNCTIONS",
    "RULE_RESULT_SCHEMA",
    "RowRule",
    "RuleContext",
    "RuleSpec",
    "SetRule",
    "TableResolver",
    "append_audit",
    "catalog_tables",
    "check_completeness",
    "check_reconciliation",
    "check_timeliness",
    "check_uniqueness",
    "dq_check",
    "frames",
    "parquet_tables",
    "plan_dq_from_config",
    "query_history",
    "query_log_window",
    "read_config",
    "run_audit_job",
    "run_check",
    "run_dq_checks",
    "run_dq_from_config",
    "write_dq_results",
]
