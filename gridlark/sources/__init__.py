"""Workbook formats, their containers, and the Spark data sources."""
