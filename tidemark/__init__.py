"""tidemark: ingestion, data-quality and refinement jobs for a payments lakehouse on Spark."""
