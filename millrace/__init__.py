"""millrace: corpus building and corpus analytics on Spark DataFrames."""
