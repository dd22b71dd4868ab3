"""palimpsest: revision histories to preference data on Spark DataFrames."""
