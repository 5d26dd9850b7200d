"""Analytics over archives of short news texts, built on Spark DataFrames."""
