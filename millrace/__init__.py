"""A PySpark-native engine for building, auditing and evaluating structured text corpora."""
