"""Operators for preparing training text: cleaning, matching, scoring and mixing of documents."""
