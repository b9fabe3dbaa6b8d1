"""Basket mining, period clustering and similar-document search as Spark DataFrame jobs."""
