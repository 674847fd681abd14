"""payloom: accounts-payable analytics expressed as Spark DataFrames."""
