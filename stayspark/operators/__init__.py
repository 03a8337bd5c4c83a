"""Lodging operators: functions from DataFrames to DataFrames."""
