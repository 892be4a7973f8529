"""Shipment risk, carbon and allocation jobs on Spark."""
