"""Structured Streaming jobs over translation logs and transcripts."""
