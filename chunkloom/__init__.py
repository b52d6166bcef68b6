"""A PySpark-native engine that turns document collections into linked, searchable chunks."""
