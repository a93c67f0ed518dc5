"""docmill: incremental document processing and corpus preparation on Spark DataFrames."""
