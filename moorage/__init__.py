"""Spark-native landing, quality gating and publishing of public-sector tabular and spatial data."""

__version__ = "0.1.0"
