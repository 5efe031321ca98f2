"""Operators put together: the study/contract/invoice/sponsor domain and the load jobs."""
