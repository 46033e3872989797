"""Streaming form of the row-level checks over a landing folder."""
