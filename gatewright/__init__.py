"""Contract-checked data ingestion and table profiling as PySpark DataFrame operators."""
