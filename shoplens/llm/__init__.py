"""Operators for building language-model training data.

One module per operator, each with a general interface over DataFrames; ``queries`` holds the registered queries.
Nothing else in the library imports this package.
"""
