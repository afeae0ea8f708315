"""Readers for files, Kafka topics and lookup tables."""
