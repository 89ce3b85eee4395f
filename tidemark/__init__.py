"""Time-series tables and streams on Spark, as functions over DataFrames and Columns."""
