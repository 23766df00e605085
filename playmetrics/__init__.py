"""Player and purchase analytics as Spark DataFrame functions."""

from playmetrics.schema import GameTables

__all__ = ["GameTables"]
