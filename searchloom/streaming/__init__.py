"""Structured Streaming jobs: running fetch counts and conversation memory."""
