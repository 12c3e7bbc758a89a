"""Operators for preparing training text for language models, and their queries."""
