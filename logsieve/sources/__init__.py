"""Readers: files by extension, message streams, the tools dimension."""
