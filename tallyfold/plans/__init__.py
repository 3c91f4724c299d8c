"""Whole plans: from source tables to stored stages and reports."""
