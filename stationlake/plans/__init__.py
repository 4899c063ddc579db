"""Query registry (``queries()``), oracle SQL and end-to-end jobs."""
