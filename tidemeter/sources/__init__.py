"""Sources: Kafka and its file-backed twin, files, collector batches, generated events."""
