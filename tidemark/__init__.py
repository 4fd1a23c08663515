"""Tidemark: table operators for a layered (landing, staging, dimensional)
warehouse, written with Spark DataFrames and Spark SQL."""
