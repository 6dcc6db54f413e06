"""Readers and writers for every source and sink kind the reference uses."""
