"""gridloom: cohort-scale matrix data (sites x samples) as Spark DataFrames."""
