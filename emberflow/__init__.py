"""emberflow: a Spark-native e-commerce event and order warehouse.

Every transform takes and returns a DataFrame, so the same code runs in
batch (checked against a DuckDB oracle) and on Structured Streaming.
"""

__version__ = "0.1.0"
