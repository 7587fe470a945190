"""A bitemporal replication and change-history engine on Spark DataFrames."""
