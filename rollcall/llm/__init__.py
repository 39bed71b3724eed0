"""Training-data operators over the document tables.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered ``opN_*`` queries and their SQL.
"""
