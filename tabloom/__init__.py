"""Tabular machine-learning data work expressed as Spark DataFrame operators.

Every function takes and returns DataFrames (or fitted Spark ML models); none of
them starts a session.  See README.md for a tour.
"""
