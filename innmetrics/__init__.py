"""Marketplace funnel analytics as Spark jobs."""

from innmetrics.config import Config
from innmetrics.sources.tables import MarketTables

__all__ = ["Config", "MarketTables"]
