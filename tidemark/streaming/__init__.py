"""Structured Streaming jobs: notifications in, tables and notifications out."""
