"""Whole queries: operators put together."""
