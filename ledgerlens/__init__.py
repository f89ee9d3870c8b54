"""ledgerlens: retail star-schema analytics, a semantic layer and dashboard queries on Spark."""

__version__ = "0.1.0"
