"""An order warehouse built with Spark DataFrames: raw, staging, analytics and marts."""
