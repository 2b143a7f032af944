"""Readers that produce canonical events, and writers."""
