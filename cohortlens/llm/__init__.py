"""Training-data operators: ten corpus operators and the queries that apply them.

Nothing else in the library imports this subpackage. ``registry`` holds the
queries; each other module is one operator (or a helper that several share).
"""
