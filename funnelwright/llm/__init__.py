"""Operators for preparing training data, with their queries (``llm.registered``)."""
