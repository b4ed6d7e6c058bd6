"""Operators: numeric statistics, word counts, vector distances and clustering, paging."""
