"""Retail clickstream analytics on Spark.

DataFrame functions live in ``operators``; ``plans`` joins them to catalog
tables as runnable jobs; ``streaming`` holds the ingestion query.
"""
