"""foliant: a Spark-native engine for document-figure analytics."""
