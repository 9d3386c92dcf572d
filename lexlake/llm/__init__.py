"""Operators of a training-data pipeline over a table of documents.

Every operator takes the names of the id and the text column and reads nothing else
unless told to carry rows, so further columns never clash with what it adds. A null
text counts as an empty one.
"""
