"""trajkit: labelled-movement analytics expressed as Spark DataFrames."""
