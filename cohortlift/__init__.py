"""Customer and campaign analytics over a star schema, expressed as Spark DataFrames."""

__version__ = "0.1.0"
