"""Structured Streaming: the enrichment as micro-batches."""
