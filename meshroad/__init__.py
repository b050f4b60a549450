"""Meshroad: traffic-volume and area-code enrichment of incident records on Spark."""
