"""Spark-native operators for applied-statistics and table-learning work.

Every operator is a function from DataFrames to a DataFrame.
"""

from lodestat.session import build_session, checkpointed

__all__ = ["build_session", "checkpointed"]
