"""Whole jobs: the enrich procedure, the task chain, and the reports."""
