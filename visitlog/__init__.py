"""Visitor-log analytics as plain Spark DataFrame functions.

Every function takes DataFrames and column names and returns a DataFrame; the
plan stays lazy until the caller writes or reads it.
"""
