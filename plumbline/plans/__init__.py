"""Many checks in few scans."""

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

__all__ = [
    "AuditParams",
    "check_completeness",
    "check_reconciliation",
    "check_timeliness",
    "check_uniqueness",
    "plan_dq_from_config",
    "run_audit_job",
    "run_check",
    "run_dq_checks",
    "run_dq_from_config",
]
