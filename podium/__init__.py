"""podium: a Spark-native recommendation and monitoring engine.

Public functions take and return DataFrames. Nothing is collected to the
driver except metadata whose size is bounded (schemas, one-row aggregates,
per-partition counts, small model parameters).
"""

__version__ = "0.1.0"
