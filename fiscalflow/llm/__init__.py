"""Operators for preparing training text at scale; see ``queries`` for the registered ones."""
