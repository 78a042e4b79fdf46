"""Windowed roll-ups, reports and k-means for metering data on Spark."""

from meterfold.session import build_session, sized_for

__all__ = ["build_session", "sized_for"]
