"""Spark-first tabular analytics, model preparation and label auditing."""
