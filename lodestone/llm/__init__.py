"""Operators for preparing training data: formatting, deduplication, tokenizing, filtering and cleaning of text."""
