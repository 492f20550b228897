"""methylspark: single-cell methylome analytics as lazily planned Spark DataFrames."""
