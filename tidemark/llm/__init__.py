"""Operators for training data: one module each, named queries in ``queries``."""
