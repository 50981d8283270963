"""Service-regularity analytics for polled vehicle positions, on Spark DataFrames."""

__version__ = "0.1.0"
