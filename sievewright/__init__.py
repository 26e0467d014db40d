"""Curation and decision analytics on PySpark."""
