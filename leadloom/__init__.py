"""Customer propensity and lead allocation on PySpark DataFrames."""
