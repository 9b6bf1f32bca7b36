"""Structured Streaming pipeline and stateful operators."""
