"""Training-data operators: deduplication, filtering, extraction, mixing and tokenisation.

Nothing else in the library imports this subpackage.
"""
