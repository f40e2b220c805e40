"""Structured Streaming jobs for scheduled re-runs and alerts."""
