"""Spark-native analytics over tables of product reviews."""
