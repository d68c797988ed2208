"""Record tables on Spark: read, validate, impute, label, store and summarise."""
