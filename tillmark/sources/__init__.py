"""Readers, schemas, sinks and the mapping of the test tables."""
