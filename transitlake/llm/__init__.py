"""Operators of a training-data pipeline, built apart from the rest of the library.

Each module holds one operator with a general interface; ``queries`` applies all
of them to the shared tables.
"""
