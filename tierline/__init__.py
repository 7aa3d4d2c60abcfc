"""Medallion pipeline and daily-series analytics, written as Spark DataFrame functions."""
