"""Data quality, imputation and profiling operators over Spark DataFrames."""
