"""Catalog and market-observation analytics on PySpark."""
