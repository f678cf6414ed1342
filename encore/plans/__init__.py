"""Composed plans: the query catalogue, SQL twins, the job CLI and comparisons."""
