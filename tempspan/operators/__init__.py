"""Operators on observations: daily extremes, periods, quality report, views."""
