"""Spark-native operators for detection datasets: reading, checking, matching, merging, reporting."""
