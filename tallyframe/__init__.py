"""Spark-first analytics over sequencing-derived tables."""
