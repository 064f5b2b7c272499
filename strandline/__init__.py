"""Interval, ranking, clustering, sequence and audit operators on PySpark DataFrames."""
