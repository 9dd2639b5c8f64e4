"""A PySpark-native engine for web-link analytics."""
