"""A Spark-native engine for turning document collections into checked, linked, flat records."""

__version__ = "0.1.0"
