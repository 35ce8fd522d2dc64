"""Reading and writing: events, CSV, Kafka, tables."""
