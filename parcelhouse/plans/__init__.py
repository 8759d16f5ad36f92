"""Table builds, checks, audits and reports: DataFrames in, a DataFrame out."""
