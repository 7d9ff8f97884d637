"""Spark-native processing of event, packet and market-context tables.

The package is split into `functions` (column expressions), `sources` (reading and
ingesting), `operators` (DataFrame in, DataFrame out), `streaming` (Structured
Streaming jobs and idempotent sinks) and `plans` (the registered queries with the SQL
they must equal).  The subpackage `llm` is optional and nothing here imports it.
"""
