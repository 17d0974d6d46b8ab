"""Operators put together: the full run and the registered queries."""
