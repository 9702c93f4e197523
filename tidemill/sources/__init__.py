"""Readers with explicit schemas, record extraction and sinks."""
