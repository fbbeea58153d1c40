"""Readers, writers and the test-table adapter."""
