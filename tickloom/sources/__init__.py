from tickloom.sources.files import envelope_files, read_envelopes
from tickloom.sources.kafka import kafka_stream, kafka_topic
from tickloom.sources.lake import read_lake

__all__ = ["envelope_files", "kafka_stream", "kafka_topic", "read_envelopes", "read_lake"]
