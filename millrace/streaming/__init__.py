"""Structured Streaming: built-in windows where they suffice, keyed state where they don't."""
