"""Sales, returns, stock and order reporting tables, built with Spark DataFrames."""
