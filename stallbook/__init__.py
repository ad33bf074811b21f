"""Marketplace warehouse and reporting jobs expressed as PySpark DataFrame plans."""
