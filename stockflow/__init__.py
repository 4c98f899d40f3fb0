"""Stockflow: a supply-chain inventory lakehouse expressed as Spark DataFrame jobs."""
