"""Advertising-campaign analytics as plain PySpark DataFrame functions."""
