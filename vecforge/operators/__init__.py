"""Operators: row ids, pair scores, block kNN and votes, PCA, classifiers, metrics."""
