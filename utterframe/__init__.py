"""A PySpark-native analytics engine for time-aligned speech data."""
