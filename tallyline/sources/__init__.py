"""Readers, landing checks and file sinks."""
