"""Writers for Parquet folders, Kafka topics, the console and serving tables."""
