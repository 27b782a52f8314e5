"""Operators for building text corpora: one module per operator, queries in ``queries``."""
