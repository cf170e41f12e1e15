"""Structured Streaming forms of the cleaning, tagging, panel and scoring steps."""
