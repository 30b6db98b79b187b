"""Sinks, keyed tables, keyed state and the running click application."""
