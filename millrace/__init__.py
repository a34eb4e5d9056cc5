"""millrace: a Spark-native engine for raw text corpora."""
