"""A PySpark-native toolkit for curating large collections of semi-structured event records."""
