"""Structured Streaming sinks for the KPI store."""
