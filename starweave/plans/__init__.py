"""Model plans: dimensions, facts, metrics, checks, incremental runs, storage."""
