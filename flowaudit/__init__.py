"""flowaudit: monitoring analytics for data-replication pipelines on Spark."""

from flowaudit.session import build_session, checkpoint_root, use_utc

__all__ = ["build_session", "checkpoint_root", "use_utc"]
