"""Micro-batch driving of incremental loads with Structured Streaming."""
