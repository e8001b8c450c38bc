"""Spark-first regression analytics: a JSON query language compiled to DataFrames, statistics and alerting."""
