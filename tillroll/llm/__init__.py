"""Operators of a training-data pipeline (deduplication, filters, packing, ...).

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries, ``oracle`` their SQL where SQL can express them.
"""
