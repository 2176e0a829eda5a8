"""Property graphs over plain DataFrames: ingest, entity resolution, graph queries and analytics on Spark."""

from .session import build_session, materialize

__all__ = ["build_session", "materialize"]
