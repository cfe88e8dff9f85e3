"""The registered queries, and the same results as plain SQL."""
