"""quarrykit: dataset-quality operators for Spark DataFrames."""
