"""Siftstone: a Spark-native engine that curates media candidates and the tables around them."""
