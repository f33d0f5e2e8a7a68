"""martforge: daily event/transaction marts expressed as Spark DataFrame plans.

Every operator is a plain ``DataFrame -> DataFrame`` function built on
``pyspark.sql.functions``; nothing collects to the driver inside a transform
and no wall clock is read inside a query.
"""

__version__ = "0.1.0"
