"""distriq: periodic-payout analytics and data preparation on Spark DataFrames."""
