"""Readers with declared schemas, and the table sinks."""
