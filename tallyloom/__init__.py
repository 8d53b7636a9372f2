"""tallyloom: set-based ratings and channel-log analytics on Spark DataFrames."""
