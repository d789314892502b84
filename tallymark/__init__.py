"""Spark-first analytics and supervised learning over typed tables."""
