"""Whole jobs: building an index, recommending, answering requests, comparing engines."""
