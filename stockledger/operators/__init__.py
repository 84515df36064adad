"""Operators: DataFrame -> DataFrame functions (calendar, sales, weekly, customers, quality, explore)."""
