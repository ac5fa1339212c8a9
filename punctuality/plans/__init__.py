"""Whole runs: the dataset pipeline, and the registered queries over the test tables."""
