"""Learning-activity analytics on Spark: history features, matrices, classifiers."""
