"""Feeds, lists and pages as DataFrames."""
