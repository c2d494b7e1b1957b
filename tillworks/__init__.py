"""Spark-native retail sales analytics: catalog cleaning, star schema, sales reports and data movement."""
