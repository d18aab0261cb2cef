"""Operators of a training-data pipeline over documents, pages and embeddings.

One module per operator; ``registry`` holds the registered queries. Nothing
else in the library imports this subpackage.
"""
