"""Column functions: `Column -> Column`, built from Spark's own expressions only."""
