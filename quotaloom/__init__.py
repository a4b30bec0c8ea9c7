"""quotaloom: a PySpark-native engine for building quota-balanced, auditable text datasets."""

__version__ = "0.1.0"
