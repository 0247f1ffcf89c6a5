"""wattline: half-hourly energy cost analytics on Spark DataFrames."""

__version__ = "0.1.0"
