"""Tables, text parsers, Kafka connector options and sinks."""
