"""Spark-native analytics for governing tabular risk scores.

Every operator takes and returns a DataFrame, names its columns through
arguments, and leaves reading, writing and the session to its caller.
"""

__version__ = "0.1.0"
