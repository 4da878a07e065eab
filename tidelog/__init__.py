"""tidelog: change data capture, snapshots and apply on Spark DataFrames."""
