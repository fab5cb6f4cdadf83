"""Relational operators of the reconciliation, each a lazy DataFrame transform."""
