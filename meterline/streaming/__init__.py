"""Structured Streaming parts: per-key patterns, late routing, sinks, job sets."""
