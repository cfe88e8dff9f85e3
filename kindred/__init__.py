"""Batch search for similar products on Apache Spark."""
