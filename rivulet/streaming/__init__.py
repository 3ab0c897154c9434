"""Structured Streaming forms of the keyed, windowed and stateful operators."""
