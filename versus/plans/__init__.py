"""Whole queries: fixtures over the given tables, sweeps, the registry and its oracle SQL."""
