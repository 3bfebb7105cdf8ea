"""cartolux: optical-map analytics and data preparation expressed on Spark DataFrames."""

__version__ = "0.1.0"
