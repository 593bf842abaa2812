"""Operators of a training-data pipeline over the ``documents`` table.

One module per operator, each usable on its own; ``queries`` holds the
registered ``opN_<name>`` queries. Nothing else in the library imports
this subpackage.
"""
