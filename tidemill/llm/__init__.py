"""Training-data operators: one module per operator, ``queries`` lists the registered queries.

Nothing else in the library imports this subpackage.
"""
