"""Operators on whole tables: fitted transforms, search, fusion, evaluation."""
