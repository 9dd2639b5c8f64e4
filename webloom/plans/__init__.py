"""Whole plans: marts as SQL views, jobs, and the registry of queries."""
