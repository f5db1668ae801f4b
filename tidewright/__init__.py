"""Disclosure and market-supply analytics on Spark."""
