"""Structured Streaming source, validity-routed sink, progress log, runner."""
