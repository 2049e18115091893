"""All named queries, gathered from the modules that define them."""

from __future__ import annotations

from flowaudit.plans import (  # noqa: F401
    batches,
    compare,
    history,
    lag,
    logs,
    payloads,
    snapshots,
    streams,
    tables,
)
from flowaudit.plans.registry import EXPECTED_SQL, QUERIES

__all__ = ["EXPECTED_SQL", "QUERIES"]
