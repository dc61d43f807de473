"""Structured news events on Spark: load, classify, extract, evaluate.

Every operator is a function from DataFrame to DataFrame or from Column to
Column, so that Catalyst sees the whole plan.
"""
