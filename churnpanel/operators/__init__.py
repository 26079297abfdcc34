"""Operators: functions from DataFrames to a lazy DataFrame."""
