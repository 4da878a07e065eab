"""Columns and values: positions, log sequence numbers, database types, Avro schemas."""
