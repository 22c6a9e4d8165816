"""Table synchronization, change tracking and reverse ETL on Spark DataFrames."""
