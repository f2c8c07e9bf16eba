"""Plans: the batch job, the registered queries and their DuckDB oracle SQL."""
