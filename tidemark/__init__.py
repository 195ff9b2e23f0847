"""Customer, seller and churn analytics for marketplace data on Spark DataFrames."""
