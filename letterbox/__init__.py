"""Metadata-driven ingestion on Spark.

Every message is a JSON envelope naming its destination table, the table's
keys and write mode, and the schema of its own payload.  The package turns a
bounded or streaming read of such messages into typed, date-partitioned
tables with the DataFrame API, Spark SQL and Structured Streaming.
"""
