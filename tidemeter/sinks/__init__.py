"""Sinks: layer tables, exports, Kafka records."""
