"""Structured Streaming jobs of the speed layer."""
