"""Model preparation, training and evaluation on Spark ML."""
