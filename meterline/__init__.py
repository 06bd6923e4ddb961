"""Streaming and table analytics for ride events, written as Spark jobs."""
