"""Click-stream analytics on Spark: ingest, enrich, video engagement, star schema, reports."""

from clickloom.session import build_session, configure

__all__ = ["build_session", "configure"]
