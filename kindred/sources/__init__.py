"""Readers and writers: the raw catalogue and the tables built from it."""
