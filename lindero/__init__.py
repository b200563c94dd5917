"""A Spark-native engine for web-listing analytics."""
