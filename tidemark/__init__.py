"""Spark-native medallion processing for e-commerce orders: bronze, silver, gold."""
