"""City-level housing-market tables, trends, scores and rankings on Spark DataFrames."""
