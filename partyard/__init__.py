"""Spark-native analytics for resale-marketplace listings of used vehicle parts."""

__version__ = "0.1.0"
