"""Spark-native activity-event mart: conform, star schema, analysis views and ML tables."""

__version__ = "0.1.0"
