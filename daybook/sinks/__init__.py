"""Sinks for daily aggregates and dead letters."""
