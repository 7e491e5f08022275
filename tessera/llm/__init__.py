"""Training-data operators: de-duplication, filtering, extraction, tokenisation and search.

Nothing outside this package imports it.
"""
