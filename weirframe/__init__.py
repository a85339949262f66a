"""Spark jobs that turn landed environmental-monitoring JSON into keyed tables."""
