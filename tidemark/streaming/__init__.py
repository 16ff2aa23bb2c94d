"""Streaming: running streams, sinks, the keyed cache, state as tables."""
