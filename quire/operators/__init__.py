"""Core operators."""
