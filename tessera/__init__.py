"""tessera: text and table analytics on Spark DataFrames."""
