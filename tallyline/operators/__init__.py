"""Operators over DataFrames. None of them runs an action."""
