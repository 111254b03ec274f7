"""Structured Streaming: checkpointed sinks, several queries side by side, bounded stream joins."""
