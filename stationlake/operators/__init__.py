"""DataFrame operators: joins, summaries, analytics, quality, versions."""
