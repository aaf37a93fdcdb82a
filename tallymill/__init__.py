"""Spark-native curation of interaction logs into labelled, de-duplicated, agreement-measured evaluation data."""
