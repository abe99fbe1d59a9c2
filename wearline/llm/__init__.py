"""Operators for the preparation of training text at scale, and their registered queries."""
