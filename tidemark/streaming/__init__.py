"""Resumable incremental runs on Structured Streaming."""
