"""feedmill: a Spark-native engine for listing feeds and corpus preparation."""
