"""Service-punctuality analytics as plain PySpark DataFrame and Column functions."""

from punctuality.config import MatchConfig

__all__ = ["MatchConfig"]
