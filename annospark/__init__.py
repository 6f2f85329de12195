"""Image-annotation data preparation and detection evaluation on Spark DataFrames."""
