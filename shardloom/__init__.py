"""Spark-native engine that turns tables of URLs and text into sharded, queryable datasets."""
