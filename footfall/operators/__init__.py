"""Operators: functions from DataFrames to DataFrames, shared by batch jobs and streams."""
