"""Operators on document, line, block, window and chunk tables."""
