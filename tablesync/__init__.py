"""Table replication and reconciliation on Spark DataFrames."""
