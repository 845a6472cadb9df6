"""limnos: overlapping sensor snapshots resolved at read time, on Spark DataFrames."""
