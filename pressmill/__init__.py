"""Web-document analytics on Spark: URL rules, extraction, cleaning, enrichment, feeds and monitoring."""
