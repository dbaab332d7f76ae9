"""Polling-station turnout analytics as Spark DataFrame operations."""
