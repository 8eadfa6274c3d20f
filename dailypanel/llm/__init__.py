"""Operators for text corpora; nothing else in the library imports this subpackage."""
