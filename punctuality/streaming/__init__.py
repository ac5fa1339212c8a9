"""Incremental runs over snapshots as they arrive."""

from punctuality.streaming.audit import audit_days, collect_reports, read_audit
from punctuality.streaming.match import (
    FILES_PER_BATCH,
    collect_arrivals,
    compact,
    match_arrivals,
    match_waiting,
    read_documents,
    read_matches,
    read_passages,
    read_quarantine,
    read_rollups,
    read_samples,
    replay_mended,
)
from punctuality.streaming.rematch import rematch

__all__ = [
    "FILES_PER_BATCH",
    "audit_days",
    "collect_arrivals",
    "collect_reports",
    "compact",
    "match_arrivals",
    "match_waiting",
    "read_audit",
    "read_documents",
    "read_matches",
    "read_passages",
    "read_quarantine",
    "read_rollups",
    "read_samples",
    "rematch",
    "replay_mended",
]
