"""Text enrichment and entity linking on Spark DataFrames."""
