"""Training-data operators: one module each, built on Spark DataFrames."""
