"""folio: a ratings-analytics pipeline written against the Spark DataFrame, SQL and
Structured Streaming APIs (bronze ingestion, silver cleaning, gold views, serving,
profiling and an enrichment loop)."""

__version__ = "0.1.0"
