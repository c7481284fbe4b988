"""Delivery-performance analytics as Spark DataFrame operators."""
