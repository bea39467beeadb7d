"""storyspark: story curation on Spark DataFrames."""
