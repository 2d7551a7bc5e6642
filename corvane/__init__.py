"""corvane: annotation-dataset analytics on Spark DataFrames."""
