"""textpanel: a Spark-native engine for panels of long-form text records."""
