"""Structured Streaming form of the judging flow."""
