"""Spark-native analytics for association results, genomic intervals and text corpora."""
