"""Training-data operators: filtering, near duplicates, extraction, formatting, encoding.

Nothing else in the library imports this subpackage. ``registry`` holds its queries and SQL.
"""
