"""Civic open-data tables on Spark: landing scans, schema contracts, enrichments, checks and analytics."""
