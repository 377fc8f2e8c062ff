"""Tidewatch: activity analytics for public repository events, on Spark."""

from tidewatch.session import build_session, configure

__all__ = ["build_session", "configure"]
