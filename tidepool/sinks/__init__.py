"""Sinks: text/console, idempotent batched JDBC, pipelined key-value."""
