"""Readers of raw change files, notifications and tables."""
