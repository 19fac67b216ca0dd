"""End-to-end pipelines and the catalogue of runnable queries."""
