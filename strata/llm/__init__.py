"""Operators for preparing language-model training data (see ``registry`` for the queries).

Nothing else in the library imports this subpackage.
"""
