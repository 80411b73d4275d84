"""cotejo: a Spark-native engine for building, reconciling and auditing document corpora."""
