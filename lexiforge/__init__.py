"""Lexiforge: document intelligence and analytics as PySpark DataFrame operators."""
