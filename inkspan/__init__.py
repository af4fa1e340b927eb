"""inkspan: text-archive analytics expressed as Spark DataFrames."""
