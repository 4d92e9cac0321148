"""Training-data operators for text corpora, written as Spark jobs.

Nothing else in the library imports this package.
"""
