"""Batch and streaming readers with declared schemas."""
