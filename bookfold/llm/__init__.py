"""Operators for preparing training corpora; nothing else in the library depends on this package."""
