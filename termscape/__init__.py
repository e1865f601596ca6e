"""termscape: semantic analysis of large text collections with PySpark DataFrames."""

__version__ = "0.1.0"
