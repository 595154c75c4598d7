"""Operators for training corpora; their queries and SQL are in ``queries`` and ``oracles``."""
