"""Loomcast: a Spark-native analytics engine for large corpora of time-coded text."""
