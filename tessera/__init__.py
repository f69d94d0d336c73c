"""tessera: surface-mesh analytics on Spark DataFrames."""
