"""PySpark-native toolkit for per-frame motion-trajectory datasets."""
