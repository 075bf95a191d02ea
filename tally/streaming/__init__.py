from tally.streaming.batches import audit_stream, read_batches, validate_stream, violations_stream

__all__ = ["audit_stream", "read_batches", "validate_stream", "violations_stream"]
