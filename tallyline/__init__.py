"""Data conformance, matching, change capture and reconciliation on Spark DataFrames."""
