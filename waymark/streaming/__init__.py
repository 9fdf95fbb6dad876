"""Structured Streaming: exactly-once landing and the stateful fold."""
