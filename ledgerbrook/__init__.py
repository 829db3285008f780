"""Bulk and streaming analysis of order, inventory and payment events on Spark."""
