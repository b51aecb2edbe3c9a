"""Tidemark: DataFrame operators and analytic plans for PySpark."""
