"""tidelog: a PySpark-native engine for change logs and the tables they describe."""

__version__ = "0.1.0"
