"""Interval time-series analytics expressed as Spark DataFrame jobs."""

from slotwise.config import SeriesConfig

__all__ = ["SeriesConfig"]
