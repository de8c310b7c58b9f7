"""Layered (bronze, silver, gold) batch analytics expressed as Spark DataFrame jobs."""
