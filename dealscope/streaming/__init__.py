"""Streaming jobs over event files."""
