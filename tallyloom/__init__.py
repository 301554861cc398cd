"""Reusable analytics operators for Spark DataFrames.

Every operator takes DataFrames plus column names and returns a DataFrame; none creates a session
and none brings row data to the driver.
"""
