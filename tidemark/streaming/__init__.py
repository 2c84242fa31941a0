"""Structured Streaming jobs: live bars, dedup, keyed state, micro-batch scoring."""
