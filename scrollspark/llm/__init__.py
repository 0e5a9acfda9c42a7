"""Training-data operators: formatting, archives, filters, deduplication, mixing, tokens.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
thin queries, one per operator; every operator module has its own interface.
"""
