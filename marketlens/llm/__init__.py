"""Operators for preparing training data: one module per operator, each with its registered query.

``catalog`` collects the queries. Nothing else in the library imports this subpackage.
"""
