"""Daily market bars and financial news on Spark DataFrames."""
