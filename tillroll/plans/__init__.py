"""Jobs, the query registry and its oracle SQL."""
