"""Operators for large text corpora: cleaning, scoring, mixing and token output.

Nothing else in the package imports this subpackage. Each module holds one operator
and its thin query; ``queries`` imports them all so that they register.
"""
