"""Operators that prepare text for training: nine problems, one module each.

Nothing outside this package imports it; its queries and SQL are in ``lawweave.llm.queries``.
"""
