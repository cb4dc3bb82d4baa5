"""Operators on text corpora: deduplication, classification, redaction, tokens, search, mixing.

Nothing outside this folder imports it, so the rest of the library works without it.
"""
