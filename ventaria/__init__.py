"""Retail sales analytics as declarative Spark DataFrame jobs."""
