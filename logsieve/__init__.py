"""logsieve: security-log parsing and enrichment as Spark DataFrame jobs."""

from logsieve.session import checkpoint_location, configure

__all__ = ["checkpoint_location", "configure"]
