"""Retail stock and sales analytics as PySpark DataFrame operators."""
