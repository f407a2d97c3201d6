"""Operators that prepare text corpora for model training.

Nothing outside this package imports it; ``queries`` registers one thin query
per operator, the other modules hold the operators themselves.
"""
