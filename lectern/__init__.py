"""A PySpark-native engine for batch processing of recorded talks."""
