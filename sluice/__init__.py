"""sluice: a Spark-native engine for grounded instruction datasets."""
