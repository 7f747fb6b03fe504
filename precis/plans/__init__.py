"""Whole flows: files to cleaned pairs, pairs to scores, cleaned reviews to product summaries."""
