"""Structured Streaming sinks, stateful assembly and jobs."""
