"""Table operators for batch and incremental ETL on Spark DataFrames."""
