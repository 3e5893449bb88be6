"""Training-data operators for large text tables.

One module per operator; ``queries`` registers one query for each. Nothing
outside this subpackage imports it.
"""
