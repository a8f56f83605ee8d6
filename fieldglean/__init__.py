"""Extraction, cleaning, profiling and versioning of raw tables, document pages, web pages and logs on Spark."""
