"""Spark-first table operators and reports."""
