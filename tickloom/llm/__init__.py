"""Training-data operators: one module per operator, plus shared helpers.

Nothing outside this package imports it; deleting the folder leaves the rest of the library working.
"""
