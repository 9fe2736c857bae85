"""Declared schemas, table access and the test tables."""
