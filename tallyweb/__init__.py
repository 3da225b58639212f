"""Listing pages to product rows, as Spark jobs."""
