"""Listing and event-return analytics as PySpark DataFrame operators."""
