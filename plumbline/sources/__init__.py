"""Where tables come from and where audit records go."""

from plumbline.sources.audit_log import append_audit, write_dq_results
from plumbline.sources.query_log import query_history, query_log_window
from plumbline.sources.tables import catalog_tables, frames, parquet_tables

__all__ = [
    "append_audit",
    "catalog_tables",
    "frames",
    "parquet_tables",
    "query_history",
    "query_log_window",
    "write_dq_results",
]
