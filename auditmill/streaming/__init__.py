"""Arriving artifacts as a stream, scanned by the same operators as in batch."""
