"""pairmill: a Spark-native engine that curates and evaluates parallel text."""
