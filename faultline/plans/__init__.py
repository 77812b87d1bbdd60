"""Composed plans: the registered queries (with SQL oracles) and the jobs."""
