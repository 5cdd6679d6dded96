"""Streaming jobs: tenant counters and the staged document flow."""
