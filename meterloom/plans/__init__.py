"""Whole jobs assembled from the operators, and the query catalogue."""
