"""Decision analytics for an online-retail star schema, on Spark DataFrames."""

__version__ = "0.1.0"
