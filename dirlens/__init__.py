"""dirlens: directory-data cleaning, deduplication, scoring and market analytics on Spark.

Every operator is a function from DataFrames (or Columns) to DataFrames (or Columns).
"""

__version__ = "0.1.0"
