"""Streams: the engine's expressions over Structured Streaming (an extension)."""
