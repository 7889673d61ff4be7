"""quire: analytics over paginated, weakly structured documents on Spark.

Every operator is a function from DataFrames to a DataFrame (or from Columns to a Column); nothing is collected
inside an operator unless its size is bounded by a documented parameter. The subpackage ``quire.llm`` holds the
training-text operators; nothing outside it imports it.
"""

__version__ = "0.1.0"
