"""DataFrame -> DataFrame operators: dedup, silver cleaning, gold analytics."""
