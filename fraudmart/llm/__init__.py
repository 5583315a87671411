"""Training-data operators: one module for each, ``queries`` for the driver's entries.

Nothing else in the library imports this subpackage.
"""
