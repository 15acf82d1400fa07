"""Readers: raw lake, topic or directory stream, KPI tables, and the message codec."""
