"""Operators: each function declares a DataFrame plan and leaves execution to Spark."""
