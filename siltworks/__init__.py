"""siltworks: layered warehouse loading and data quality on Spark DataFrames."""
