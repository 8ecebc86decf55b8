"""Structured Streaming wrapper of the page gate."""
