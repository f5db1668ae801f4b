"""Readers of raw payloads."""
