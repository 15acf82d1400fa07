"""Operators from event DataFrames to event, KPI and view DataFrames."""
