"""salesloom: sales landing, enrichment and reporting tables as Spark jobs."""
