"""threshline: a PySpark-native engine that prepares language-model training data."""
