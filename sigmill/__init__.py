"""A Spark-native engine for streaming and batch analytics over scored, multi-tenant entity events."""
