"""A PySpark-native engine for sentence-level text datasets."""
