"""Whole queries (reports) and the registry of query keys with oracle SQL."""
