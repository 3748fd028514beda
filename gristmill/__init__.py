"""gristmill: a PySpark-native engine for entity resolution and contact-data quality."""

__version__ = "0.1.0"
