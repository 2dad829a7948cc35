"""Training-data operators: one module per operator, queries and SQL in ``queries``.

Nothing outside this folder imports it. Shared helpers: ``shared`` (tables
in the cluster's shared folder, row-batch plumbing) and ``shingles`` (word
shingles in numpy and as Spark expressions).
"""
