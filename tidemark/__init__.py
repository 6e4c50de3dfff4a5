"""Change-event, stream and table analytics as plain PySpark functions.

Every operator takes DataFrames and returns DataFrames; streaming forms live in
``tidemark.streaming`` and reuse the batch operators wherever Spark allows it.
"""
