"""Whole jobs: pipelines, the enriched join, recipes and reports."""
