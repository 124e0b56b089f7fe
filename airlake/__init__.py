"""PySpark-native analytics over tables, text and directed graphs."""
