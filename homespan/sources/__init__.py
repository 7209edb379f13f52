"""Readers and writers: delimited feeds, JSON payload files, layer tables."""
