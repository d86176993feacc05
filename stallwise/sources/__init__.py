"""Readers, writers, the shared listing store and the test-table binding."""
