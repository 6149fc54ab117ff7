"""Spark-native connected-vehicle telemetry: ingest, validate, window, compact, analyse."""
