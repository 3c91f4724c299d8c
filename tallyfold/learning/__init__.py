"""Clustering, classification and their measures on MLlib."""
