"""Headline sentiment analytics as Spark DataFrame operators.

Functions take DataFrames or Columns and return DataFrames or Columns. Nothing here fetches
from a network, keeps state on the driver or needs a session of its own.
"""

__version__ = "0.1.0"
