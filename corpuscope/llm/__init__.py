"""Operators for preparing training data: near copies, search, mixing, extraction, tokens and scores."""
