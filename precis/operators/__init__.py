"""DataFrame operators: rows, samples, groups, token tables, scores and summaries."""
