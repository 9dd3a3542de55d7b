"""Relational operators of the credit-risk pipeline (DataFrame -> DataFrame)."""
