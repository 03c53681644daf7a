"""Operators for preparing training text, and their registered queries (``tidewater.llm.queries``)."""
