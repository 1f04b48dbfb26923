"""Operators for preparing training data: quality, deduplication, redaction,
tokenisation, packing, chat formatting, vector search and page extraction.

Nothing outside this subpackage imports it."""
