"""Spark-native store for sparse, versioned device tags and the audiences built from them."""
