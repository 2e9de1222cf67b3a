"""Structured Streaming form of the 15-minute alert schedule."""
