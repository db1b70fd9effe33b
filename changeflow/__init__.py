"""Change-data engine on Spark DataFrames: decode, filter, fold and apply row-level change events."""
