"""Operators: functions from DataFrames to a DataFrame. None of them starts a job."""
