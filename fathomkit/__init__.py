"""Fathomkit: tables in, findings out, as plain PySpark jobs."""
