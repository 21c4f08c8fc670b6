"""Master-data operators for Apache Spark: DataFrames in, DataFrames out."""
