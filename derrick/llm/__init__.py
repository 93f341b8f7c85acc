"""Operators for preparing training text: quality, language, duplicates, tokens, packing, extraction, licences."""
