"""Batch writers: raw lake, KPI tables, sample, topic."""
