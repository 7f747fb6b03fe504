"""Streams of texts."""
