"""tallyfold: yearly, place-based count data and live event feeds on Spark.

Every public operator takes DataFrames and column names and returns a lazy
DataFrame; nothing here runs outside Spark's own execution.
"""

__version__ = "0.1.0"
