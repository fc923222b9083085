"""Delivery-time analytics as Spark DataFrame jobs."""
