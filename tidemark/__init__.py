"""Analytics over long tables of repeated observations, on Spark DataFrames."""
