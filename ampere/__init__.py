"""ampere — keyed hourly time-series operators on Spark DataFrames."""

__version__ = "0.1.0"
