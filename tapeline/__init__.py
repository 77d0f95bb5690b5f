"""tapeline: a PySpark-native engine for equity price bars."""
