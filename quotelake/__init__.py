"""quotelake: multi-source market-quote ETL and analytics on Spark DataFrames."""
