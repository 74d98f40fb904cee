"""Training-data operators on Spark: dedup, filtering, cleaning, tokenizing.

Each module holds one operator with its own general interface; ``queries.py``
applies them to the test tables and derives the contracted columns.  Nothing
else in the package imports this subpackage.
"""
