"""Readers: raw CSV, column shards, message streams, the driver's event table."""
