"""Structured Streaming: topic sources, decode with watermark, raw sinks, stateful operators."""
