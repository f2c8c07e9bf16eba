"""Streaming: the same cleaners over a CSV directory that keeps receiving files."""
