"""starweave: a Spark-native star-schema engine for service-marketplace data.

Raw events, sessions, service requests, pro profiles and payments become
conformed dimensions and facts (full build or incremental with lookback,
keyed upserts and type-2 history), named metrics with guarded grouping
dimensions, and data-quality checks. Every step is a DataFrame plan.
"""

__version__ = "0.1.0"
