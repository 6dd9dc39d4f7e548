"""txrisk: transaction risk analytics on Spark.

Validation and routing of transaction messages, Parquet zones, the warehouse
star schema with an incremental fact and the fraud-metrics mart, data-quality
suites, and model training/evaluation on pyspark.ml -- all as DataFrame
functions over native Catalyst expressions, Structured Streaming and Spark ML.
"""

__version__ = "0.1.0"
