"""scarp — slope-failure early-warning analytics as Spark DataFrame functions.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) so the same code runs in batch jobs and in Structured Streaming.
"""

__version__ = "0.1.0"
