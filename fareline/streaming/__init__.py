"""Streaming form of the incremental bronze load."""
