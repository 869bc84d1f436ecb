"""Tideline: regular time series and the tables around them, on Spark."""
